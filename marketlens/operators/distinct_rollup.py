"""Exact distinct counts that add up over levels, by bitmaps.

Ids are cut into buckets of 32,768; a bitmap holds the ids of a bucket that a
group has.  Bitmaps of groups are or-ed into those of the next level, so the
rows are aggregated once, without a copy of them for each level or column.
Ids should lie close together (surrogate numbers): a bucket with one id takes
as much room as a full one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, keys: list[str], id_col: str, *more) -> DataFrame:
    """``keys``, ``bucket`` and ``ids`` (a bitmap), with further aggregates; NULL ids are in no bitmap (bucket NULL)."""
    bucket = F.bitmap_bucket_number(id_col)
    return df.groupBy(*keys, bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("ids"), *more)


def merged(maps: DataFrame, keys: list[str], *more) -> DataFrame:
    """The bitmaps of a coarser level."""
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"), *more)


def counted(maps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct ids of each group."""
    return maps.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).cast("bigint").alias(name))


def distinct_rollup(df: DataFrame, keys: list[str], id_col: str, name: str = "n") -> DataFrame:
    """Distinct ids of every group of ``keys``, of all but the last key, … and in total; left-out keys are NULL and ``level`` tells how many are kept."""
    maps, out = bitmaps(df, keys, id_col), None
    for level in range(len(keys), -1, -1):
        kept = keys[:level]
        if level < len(keys):
            maps = merged(maps, kept)
        one = counted(maps, kept, name).select(F.lit(level).alias("level"), *[F.col(k) if k in kept else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys], name)
        out = one if out is None else out.unionByName(one)
    return out
