"""Fixed-width tax roll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import keys as K
from deslinde.functions.text import strip


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines of a text file in a given encoding.

    The text source reads UTF-8 only; the CSV one, with a separator that never occurs
    and no quoting, reads whole lines in any encoding, in splits, and drops blank ones.
    """
    return (
        spark.read.schema("line string").option("sep", "\x01").option("quote", "").option("escape", "")
        .option("encoding", encoding).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def _cut(first: int, last: int) -> Column:
    return F.substring("line", first, last - first + 1)


def _number(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def parse_roll(lines: DataFrame, comuna: int | None = None) -> DataFrame:
    """Fourteen fields, ``v`` and ``_parse_ok`` per line.

    Blank fields are null. A line without a numeric commune or a key is kept and flagged.
    """
    rows = lines.where(strip(F.col("line")) != "")
    if comuna is not None:
        rows = rows.where(strip(_cut(1, 5)) == str(comuna).zfill(5))
    spans = {name: (a, b) for name, a, b in C.ROLL_FIELDS}
    text = {n: strip(_cut(a, b)) for n, (a, b) in spans.items()}
    part = lambda n: F.replace(text[n], F.lit(" "), F.lit(""))
    code = _number(text["comuna"])
    ok = F.coalesce(code.isNotNull() & (part("manzana") != "") & (part("predio") != ""), F.lit(False))
    key = lambda n: F.when(ok, K.zfill(part(n))).otherwise(F.nullif(part(n), F.lit("")))
    out = {n: F.nullif(t, F.lit("")) for n, t in text.items()}
    out |= {"comuna": code, "anio": _number(text["anio"]), "semestre": _number(text["semestre"])}
    out |= {"manzana": key("manzana"), "predio": key("predio")}
    rest = [c for c in lines.columns if c != "line"]
    fields = rows.select(*rest, *[c.alias(n) for n, c in out.items()], ok.alias("_parse_ok"))
    v = K.compose_v(F.col("comuna"), F.col("manzana"), F.col("predio"))
    return fields.withColumn("v", F.when(F.col("_parse_ok"), v))


def roll_keys(lines: DataFrame) -> DataFrame:
    """Distinct padded (manzana, predio) of lines long enough to hold them."""
    spans = {name: (a, b) for name, a, b in C.ROLL_FIELDS}
    number = lambda n: strip(_cut(*spans[n])).try_cast("bigint")
    rest = [c for c in lines.columns if c != "line"]
    keys = lines.where(F.length("line") >= C.ROLL_MIN_KEY_LENGTH).select(
        *rest, number("manzana").alias("m"), number("predio").alias("p")
    )
    pad = lambda c: K.zfill(F.col(c).cast("string"))
    return keys.where("m is not null and p is not null").distinct().select(
        *rest, pad("m").alias("manzana"), pad("p").alias("predio")
    )
