"""Size-checked broadcast.

A side is broadcast only after a bounded count proves it small; beyond the
bound the plain DataFrame is returned and Catalyst/AQE pick a shuffle join.
The count reads at most ``max_rows + 1`` rows, so the check itself is cheap
even when the side turns out to be large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``; counted on every call.

    For sides whose rows are small and of one size (ids, keys), so that the
    number of rows bounds the bytes.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
