"""The last N turns of each chat session (the agent's memory window)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_memory(turns: DataFrame, n: int = 10, session_col: str = "conv_id",
                   order_col: str = "turn") -> DataFrame:
    """Keep the newest ``n`` turns per session.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so a huge session ships at most ``n`` rows per map task.
    Turns of one number are told apart by their role and text.
    """
    ties = [c for c in ("role", "text") if c in turns.columns]
    w = Window.partitionBy(session_col).orderBy(F.desc(order_col), *ties)
    return (turns.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
            .drop("_rk"))
