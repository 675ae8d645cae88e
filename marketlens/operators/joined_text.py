"""Texts of a group joined in order, in pieces of bounded size (STRING_AGG of any length).

Rows are sorted once by group and order and stored with their partition and
position, so a large group lies in many partitions.  Each row's place in its
group's joined text is a prefix sum of lengths: of the partitions before its
own (few rows for each group), then of the rows before it in its partition.
Rows whose text begins in one range of places are one piece.  Pieces put one
after the other are the joined text, to the letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.broadcast import bounded_broadcast
from marketlens.session import materialize

#: Characters of the joined text that begin in one piece.
PIECE = 1 << 20
#: Lengths by group and partition are broadcast up to so many, counted first.
BROADCAST_LENGTHS = 100_000


def joined_pieces(rows: DataFrame, keys: list[str], text: str, order: list[str], sep: str, piece: int = PIECE) -> DataFrame:
    """``keys``, ``part`` and ``text``: the texts of each group in ``order``, joined by ``sep``, in pieces.

    NULL texts are left out; NULL keys are a group like any other.  ``order``
    should tell rows apart, so that no two partitions of the sort hold equal
    ones.  A piece is at most ``piece`` characters and one text long; parts
    ascend but may skip numbers behind a long text.
    """
    size = F.length(text) + len(sep)
    ordered = rows.where(F.col(text).isNotNull()).select(*dict.fromkeys([*keys, text, *order])).orderBy(*keys, *order)
    placed = materialize(ordered.select(*keys, F.col(text).alias("_text"), size.cast("long").alias("_size"), F.spark_partition_id().alias("_seg"),
                                        F.monotonically_increasing_id().alias("_pos")), "joined-texts")
    lengths = placed.groupBy(*keys, "_seg").agg(F.sum("_size").alias("_length"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    bases = lengths.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_seg").alias("_of_seg"), F.coalesce(F.sum("_length").over(before), F.lit(0)).alias("_base"))
    same = F.col("_seg") == F.col("_of_seg")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    inside = Window.partitionBy(*keys, "_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    begun = placed.join(bounded_broadcast(bases, BROADCAST_LENGTHS), same).select(*keys, "_text", "_pos", start.alias("_start"))
    pieces = begun.groupBy(*keys, F.floor(F.col("_start") / piece).alias("part")).agg(
        F.min("_start").alias("_first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_text"))), lambda r: r["_text"]), sep).alias("_joined"))
    lead = F.when(F.col("_first") == 0, "").otherwise(sep)
    return pieces.select(*keys, "part", F.concat(lead, F.col("_joined")).alias("text"))


def joined_texts(pieces: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One cell for each group: its pieces put together.  The cell is as long as the group's text; where that may not fit a row, read the pieces."""
    each = F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda r: r["text"])
    return pieces.groupBy(*keys).agg(F.array_join(each, "").alias(name))
