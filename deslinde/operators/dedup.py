"""First row per key under a declared order, as a combinable aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One whole row per key: the smallest by ``order``.

    ``min_by`` keeps one candidate per key on every mapper, so a key holding a
    large share of the rows costs no more than any other; ``row_number`` would
    send the whole group to one task. Columns named in ``order`` should make it total.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in rest]).select(*df.columns)
