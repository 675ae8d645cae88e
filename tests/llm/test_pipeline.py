import random

import public_tokenizers
import pytest
from test_decontaminate import plain as item_distance
from test_decontaminate import words
from test_line_dedup import brute as plain_lines
from test_simhash import groups
from test_simhash import plain as fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from marketlens.llm.common import stored
from marketlens.llm.line_dedup import Limits


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, edge_rows):
    """A small corpus with junk, copies, near copies, repeated lines and benchmark passages, as parquet tables."""
    rng = random.Random(8)
    texts = [t for i, t in edge_rows if i is not None and i >= 100 and len(t) > 300]
    own = lambda k: "".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=9))
    prose = lambda k: "\n".join(" ".join(own(k * 100 + a * 10 + b) for b in range(9)).capitalize() + "." for a in range(6))
    rows = [(k, prose(k)) for k in range(60)]
    items = [(k, " ".join(own(500_000 + k * 31 + j) for j in range(20))) for k in range(4)]
    rows += [(100 + k, rows[k][1]) for k in range(5)]                                             # copies
    rows += [(200 + k, rows[10 + k][1].replace(".", "") + " More") for k in range(5)]                # near copies
    rows += [(300 + k, prose(200 + k) + "\nThe same closing line under every text.") for k in range(10)]
    rows += [(400 + k, prose(300 + k) + "\n" + items[k % 4][1].upper()) for k in range(8)]           # passages
    junk = [(500 + k, " ".join(w + "###" for w in rng.choice(texts).split())) for k in range(40)]
    rows += junk + [(600, None), (601, ""), (None, prose(900))]
    path = str(tmp_path_factory.mktemp("corpus"))
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = [(i, int(not 500 <= (i or 0) < 600)) for i, t in rows if t]
    spark.createDataFrame(marks, "doc_id long, quality int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path, dict(items)


def test_every_stage_against_brute_force(spark, corpus):
    path, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    step = dict(corpus_pipeline.STAGES)
    assert list(step) == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    key = lambda r: str(r)

    good = stored(step["quality_classifier"](spark, docs, path), "t1")
    assert good.columns == columns
    kept = {r.doc_id for r in good.collect()}
    assert not any(500 <= (i or 0) < 600 for i in kept) and set(range(60)) <= kept and None in kept

    before = [(r.doc_id, r.text) for r in good.collect()]
    lines = stored(step["line_dedup"](spark, good, path), "t2")
    assert lines.columns == columns
    expected = [(i, t) for (i, t), (_, old) in zip(plain_lines(before, Limits()), before) if t.strip() or t == (old or "")]
    after = [(r.doc_id, r.text) for r in lines.collect()]
    assert sorted(after, key=key) == sorted(expected, key=key)
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert not any(100 <= (i or 0) < 105 for i, _ in after)

    single = stored(step["simhash_near_dedup"](spark, lines, path), "t3")
    assert single.columns == columns
    first = {}
    group = groups([fingerprint(t) for _, t in after], 4)
    for (i, t), g in zip(after, group):
        first[g] = min(first.get(g, (i is None, i or 0, t)), (i is None, i or 0, t))
    assert sorted((r.doc_id for r in single.collect()), key=key) == sorted((None if x[0] else x[1] for x in first.values()), key=key)

    clean = stored(step["benchmark_decontamination"](spark, single, path), "t4")
    assert clean.columns == columns
    dirty = lambda t: any(item_distance(words(x), words(t)) <= len(words(x)) // 5 for x in items.values())
    left = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(left, key=key) == sorted(((r.doc_id, r.text) for r in single.collect() if not dirty(r.text)), key=key)
    assert not any(400 <= (i or 0) < 404 for i, _ in left)      # the later ones lost the passage as a repeated line

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = step["bpe_encoding"](spark, clean, path).collect()
    assert sorted(((r.doc_id, r.ids) for r in coded), key=key) == sorted(((i, library.encode(t, add_special_tokens=False).ids) for i, t in left), key=key)


def test_run_and_empty_documents(spark, corpus, tmp_path):
    path, _ = corpus
    assert corpus_pipeline.run(spark, path).count() > 50
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
