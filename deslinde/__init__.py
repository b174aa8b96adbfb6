"""Cadastral parcel analytics on Spark DataFrames.

``functions`` are column expressions, ``sources`` read and write tables,
``operators`` are single DataFrame-to-DataFrame steps, ``plans`` compose
them into whole products, ``streaming`` holds the incremental forms.
"""
