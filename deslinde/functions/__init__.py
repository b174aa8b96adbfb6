"""Column expressions; everything here stays inside the JVM unless it says otherwise."""
