import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "row long, block long, key long, words string, fp long, ids string, score double, label string")


@pytest.fixture(scope="session")
def stored_docs(spark, tmp_path_factory):
    """Makes a stored documents table of (doc_id, text) rows, with extra columns whose names operators use inside."""

    def make(rows, parts=3):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        full = [(i, t, "en", "src0", len(t or ""), 7, 7, 7, "x", 7, "x", 0.5, None) for i, t in rows]
        spark.createDataFrame(full, DOCS).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


WORDS = [a + b for a in "stone river cloud maple silver harbor winter lantern copper meadow".split() for b in ("", "s", "ing", "ed", "ly")]


def prose(rng, n):
    """n words in lines that end in full stops."""
    out = []
    while n > 0:
        k = min(n, rng.randint(6, 14))
        out.append(" ".join(rng.choice(WORDS) for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(out)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, short and very long ones, repeated rows and ids, copies, odd signs."""
    rng = random.Random(5)
    base = prose(rng, 120)
    return [
        (1, None), (None, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (6, "A b c D"), (None, base), (7, base), (8, base),
        (9, base.upper()), (9, base), (9, base), (10, prose(rng, 30_000)), (11, "x" * 200_000), (12, "same " * 5000),
        (13, base + "\nOne more line stands here."), (14, "zero\0byte \x01 \x1c\x85​ 字 é́ 😀"), (15, "tab\tand  two spaces \n\n end <|endoftext|> "),
        *[(100 + k, prose(rng, rng.randint(5, 200))) for k in range(25)],
    ]
