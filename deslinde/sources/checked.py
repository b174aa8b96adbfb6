"""Readers that look at every line once: what is read, what is not and why, and the counts of both."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deslinde.functions import coords as M
from deslinde.sources.tables import text_schema

LINE, REASON = "_line", "_reason"


def read_csv_checked(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, sep: str = ",") -> DataFrame:
    """CSV as text; a line with other than the expected fields has its text in ``_line`` and the reason in ``_reason``.

    ``_lat`` and ``_lon`` are null outside the legacy box, as they are for lines with a reason.
    """
    schema = text_schema([*columns, LINE])
    rows = spark.read.schema(schema).option("header", header).option("sep", sep).option("columnNameOfCorruptRecord", LINE).csv(path)
    fields = F.size(F.split(F.col(LINE), "\\Q" + sep + "\\E", -1))
    reason = F.when(F.col(LINE).isNotNull(), F.when(fields > len(columns), "too many fields").when(fields < len(columns), "too few fields").otherwise("unreadable"))
    rows = rows.withColumn(REASON, reason)
    if not {"lat", "lon"} <= set(columns):
        return rows
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    ok = F.col(REASON).isNull() & M.valid_coord(lat, lon, legacy=True)
    return rows.withColumn("_lat", F.when(ok, lat)).withColumn("_lon", F.when(ok, lon))


def read_answers_checked(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(path, json, _line, _reason): JSON texts, one per file or one per line; what is no JSON is in ``_line``."""
    files = spark.read.option("wholetext", whole_files).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    empty = F.trim("value") == ""
    reason = F.when(empty, "empty").when(F.try_parse_json("value").isNull(), "not json")
    read = files.withColumn(REASON, reason)
    return read.select("path", F.when(F.col(REASON).isNull(), F.col("value")).alias("json"), F.when(F.col(REASON).isNotNull(), F.col("value")).alias(LINE), REASON)


@dataclass(frozen=True)
class Split:
    """What was read and what was not, as written, and how many of each there are by reason."""

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def split_checked(rows: DataFrame, folder: str, reasons: Sequence[str] = ("too many fields", "too few fields", "unreadable", "empty", "not json")) -> Split:
    """Write rows with a ``_reason`` once, good and rejected ones apart; the counts come out of the same pass."""
    seen = Observation("read")
    count = lambda condition, name: F.count_if(condition).alias(name)
    watched = rows.observe(seen, count(F.col(REASON).isNull(), "good"), *[count(F.col(REASON) == r, r) for r in reasons])
    watched.withColumn("kind", F.when(F.col(REASON).isNull(), "good").otherwise("rejected")).write.partitionBy("kind").parquet(folder)
    back = rows.sparkSession.read.schema(rows.schema.add("kind", "string")).parquet(folder)
    good = back.where("kind = 'good'").drop("kind", LINE, REASON)
    return Split(good, back.where("kind = 'rejected'").select(LINE, REASON), dict(seen.get))
