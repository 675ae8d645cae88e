"""Full-text search over a stored posting table: X1 term, X2 boolean, X3 phrase.

``postings`` holds for each lexeme (English stem, stop words left out) and
each text the positions where it stands.  It is built where the texts lie, in
long runs sorted by lexeme, so a term reads the pages of its own and no token
is moved.  A search is made of DataFrames of ids: a term is
a filter, a phrase a join of two terms on id whose positions are compared,
and, or and not are semi joins, unions and anti joins.  Words are stemmed
when the table is built, each distinct one once a task; a search's own few words
are stemmed on the driver, so no Python runs in its plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marketlens.functions.stemmer import STOP_WORDS, lexeme, stem_word

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
#: Tokens of a sorted run of postings; rows handed on at once; words whose stems a task remembers.
RUN_TOKENS, RUN_ROWS, KNOWN_WORDS = 1_000_000, 50_000, 500_000


@F.pandas_udf(StringType())
def stem_udf(words: pd.Series) -> pd.Series:
    """The stem of each (lowered) word."""
    return words.map(lambda w: None if w is None else stem_word(w))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, stem) for every non-stop-word token, positions 1-based, stop words counted.

    Each distinct token is stemmed once, vectorised, and joined back (a side
    that AQE broadcasts while it is small).
    """
    tok = (df.select(id_col, F.posexplode(tokens(F.col(text_col))).alias("pos", "tok"))
           .filter(~F.col("tok").isin(*sorted(STOP_WORDS))))
    stem = tok.select("tok").distinct().select("tok", stem_udf("tok").alias("stem"))
    return tok.join(stem, "tok").select(id_col, (F.col("pos") + 1).alias("pos"), "stem")


def _run(texts: pa.Table, known: dict[str, str | None]) -> pa.Table:
    """(stem, id, positions) of some tokenised texts, sorted by stem and place of the text."""
    lists = texts.column(1).combine_chunks()
    size = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    for word in (words := coded.dictionary.to_pylist()):
        if word not in known:
            known[word] = lexeme(word)
    stems = sorted({known[w] for w in words} - {None})
    number = {None: -1} | {x: k for k, x in enumerate(stems)}
    stem = np.array([number[known[w]] for w in words], np.int64)[coded.indices.to_numpy()]
    text = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(text)) - (np.cumsum(size) - size)[text] + 1
    kept = np.flatnonzero(stem >= 0)
    group = stem[kept] * len(size) + text[kept]
    order = np.argsort(group, kind="stable")                                  # positions of a group stay in order
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    own = kept[order][first]
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(at[kept][order], pa.int32()))
    return pa.table([pa.array(stems, pa.string()).take(pa.array(stem[own])), texts.column(0).take(pa.array(text[own])), lists], names=["stem", "id", "positions"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of a task's texts, in runs of about ``RUN_TOKENS`` tokens."""
    known: dict[str, str | None] = {}
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        ends = np.cumsum(b.column(1).value_lengths().fill_null(0).to_numpy())
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            stop = min(b.num_rows, int(np.searchsorted(ends, before + RUN_TOKENS - n)) + 1)
            held.append(b.slice(start, stop - start))
            n += int(ends[stop - 1] - before)
            start = stop
            if n >= RUN_TOKENS:
                yield from _run(pa.Table.from_batches(held), known).to_batches(RUN_ROWS)
                held, n = [], 0
                if len(known) > KNOWN_WORDS:
                    known.clear()
    if n:
        yield from _run(pa.Table.from_batches(held), known).to_batches(RUN_ROWS)


def postings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(stem, id, positions), a row for each lexeme of each text.

    The postings of a text are made in one place and not moved; those of a
    task come in runs sorted by stem.  Ids tell texts apart (equal ids count as
    one text): only texts whose id another text has too are gathered by stem
    and id.  NULL ids and texts have no postings.
    """
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("tokens"))
    schema = f"stem string, id {rows.schema['id'].dataType.simpleString()}, positions array<int>"
    again = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    if again.isEmpty():
        return rows.mapInArrow(_runs, schema)
    parts = rows.join(again, "id", "left_semi").mapInArrow(_runs, schema)
    merged = parts.groupBy("stem", "id").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
    return rows.join(again, "id", "left_anti").mapInArrow(_runs, schema).unionByName(merged)


# ---------------------------------------------------------------------------
# searches: DataFrames of ids, None where only stop words stand
# ---------------------------------------------------------------------------
def _hits(table: DataFrame, word: str, prefix: bool) -> DataFrame | None:
    stem = lexeme(word.lower())
    if stem is None:
        return None
    return table.where(F.col("stem").startswith(stem) if prefix else F.col("stem") == stem)


def term(table: DataFrame, word: str, prefix: bool = False) -> DataFrame | None:
    """Texts that hold the word (``prefix``: a lexeme that begins with its stem); None for a stop word."""
    hits = _hits(table, word, prefix)
    return hits if hits is None else hits.select("id").distinct() if prefix else hits.select("id")


def phrase(table: DataFrame, *words: str, gaps: list[int] | None = None) -> DataFrame | None:
    """Texts in which the words stand one behind the other, or ``gaps`` positions apart; stop words keep their place."""
    steps, at = gaps or [1] * (len(words) - 1), 0
    places = [0] + [at := at + s for s in steps]
    parts = [(place, hits) for place, word in zip(places, words) if (hits := _hits(table, word, False)) is not None]
    if not parts:
        return None
    first, found = parts[0]
    found = found.select("id", "positions")
    for place, hits in parts[1:]:
        beside = hits.select("id", F.transform("positions", lambda p: p - (place - first)).alias("_beside"))
        met = found.join(beside, "id").select("id", F.array_intersect("positions", "_beside").alias("positions"))
        found = met.where(F.size("positions") > 0)
    return found.select("id")


def every(*found: DataFrame | None) -> DataFrame | None:
    """Texts in all of the searches; stop words drop out."""
    left = [f for f in found if f is not None]
    out = left[0] if left else None
    for f in left[1:]:
        out = out.join(f, "id", "left_semi")
    return out


def either(*found: DataFrame | None) -> DataFrame | None:
    """Texts in one of the searches or more."""
    left = [f for f in found if f is not None]
    out = left[0] if left else None
    for f in left[1:]:
        out = out.unionByName(f)
    return out.distinct() if len(left) > 1 else out


def but_not(found: DataFrame | None, without: DataFrame | None) -> DataFrame | None:
    """Texts in the first search and not in the second."""
    return found if found is None or without is None else found.join(without, "id", "left_anti")


def matching(df: DataFrame, found: DataFrame | None, id_col: str = "id") -> DataFrame:
    """The rows whose text a search found; a search of stop words only finds nothing."""
    if found is None:
        return df.where(F.lit(False))
    return df.join(found.withColumnRenamed("id", "_found"), F.col(id_col) == F.col("_found"), "left_semi")


def with_business(b: DataFrame, hits: DataFrame) -> DataFrame:
    """Q8: matching reviews with business context, lowest stars first."""
    return (hits.select("business_id", "review_text", "stars").join(b.select(F.col("id").alias("business_id"), "business_name"), "business_id")
            .select("business_name", "review_text", "stars").orderBy(F.asc_nulls_last("stars")))


def register_sql(spark: SparkSession, table: DataFrame, name: str = "review_postings") -> None:
    """The posting table as a view, and table functions over it for callers of ``spark.sql``.

    ``texts_with('parking')`` and ``texts_with_phrase('missed', 'appointment')``
    return ids; ``stem_of(word)`` is the stemmer (it runs on the search's own
    words, one row each).
    """
    table.createOrReplaceTempView(name)
    spark.udf.register("stem_of", stem_udf)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION texts_with(word STRING) RETURNS TABLE (id BIGINT)
        RETURN SELECT id FROM {name} JOIN (SELECT stem_of(lower(texts_with.word)) AS wanted) ON stem = wanted""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION texts_with_phrase(a STRING, b STRING) RETURNS TABLE (id BIGINT)
        RETURN SELECT x.id FROM {name} x JOIN (SELECT stem_of(lower(texts_with_phrase.a)) AS first_stem) ON x.stem = first_stem
        JOIN {name} y ON y.id = x.id JOIN (SELECT stem_of(lower(texts_with_phrase.b)) AS second_stem) ON y.stem = second_stem
        WHERE arrays_overlap(transform(x.positions, p -> p + 1), y.positions)""")


def term_frequencies(table: DataFrame) -> DataFrame:
    """Document frequency and total occurrences per stem, from the posting table."""
    return table.groupBy("stem").agg(F.sum(F.size("positions")).cast("bigint").alias("occurrences"), F.count(F.lit(1)).alias("documents"))
