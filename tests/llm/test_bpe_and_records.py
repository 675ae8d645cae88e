import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlens.llm import blocks, bpe, records

FILE = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [" ", "  ", "\n", "\t", "\r\n", "\x01", "\x00", "\x1c", "\x85", "\xa0", " ", "　", "​", "a", "Bee", "é", "é",
         "1", "٣", "ⅷ", "'s", "'", ".", "!!", "_", "字", "😀", "<|endoftext|>", "<|endof", "text|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(FILE)


def test_words_join_to_the_text_and_encode_on_their_own(library, vocabulary):
    rng, keys, coder = random.Random(3), vocabulary.cutter(), vocabulary.coder()
    for _ in range(4000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 10)))
        found = [bpe.word_of(k) for k in keys(text.encode())]
        assert "".join(found) == text
        assert [i for w in found for i in coder.encode(w, allowed_special="all")] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("block_bytes,buckets", [(1 << 25, None), (2000, 3)])
def test_encode_and_decode_equal_the_library(spark, stored_docs, edge_rows, library, vocabulary, block_bytes, buckets):
    docs = stored_docs(edge_rows)
    got = bpe.decode(bpe.encode(docs, vocabulary, block_bytes, buckets), vocabulary).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in edge_rows]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert order((r.doc_id, r.ids) for r in got) == order(expected)
    assert order((r.doc_id, r.text) for r in got) == order((i, t or "") for i, t in edge_rows)


LONG = [" " * 2_000_000, "\n" * 2_000_000 + "a", "a" + " \t\n" * 700_000 + " b", "x\n" + "\u3000" * 700_000, " " * 20_000 + "<|endoftext|>" + "\n" * 20_000 + "<|endoftext|> c", "a" * 2_000_000,
        "\n" * 30_000 + "字" + " " * 30_000 + "'s"]


def test_long_white_space_equals_the_library(spark, stored_docs, library, vocabulary, tmp_path):
    coder = vocabulary.coder()
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(LONG)}
    assert all(bpe.encode_text(coder, t).tolist() == expected[i] for i, t in enumerate(LONG))
    docs = stored_docs(list(enumerate(LONG)))
    got = {r.doc_id: (r.ids, r.text) for r in bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()}
    assert got == {i: (expected[i], t) for i, t in enumerate(LONG)}
    records.write_records(docs, vocabulary, str(tmp_path / "long"))
    assert {r.doc_id: r.ids_crc32 for r in records.write_index(spark, str(tmp_path / "long")).collect()} == {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in expected.items()}


def test_other_models_are_refused(tmp_path):
    import json
    spec = json.load(open(FILE, encoding="utf-8"))
    merges = spec["model"]["merges"]
    for change in ({"merges": [merges[1], merges[0], *merges[2:]]}, {"dropout": 0.1}, {"byte_fallback": True}, {"ignore_merges": True}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | {"model": spec["model"] | change}))
        with pytest.raises(ValueError, match="needs"):
            bpe.Vocabulary(str(path))


def test_empty_table(spark, stored_docs, vocabulary, tmp_path):
    docs = stored_docs([])
    assert bpe.decode(bpe.encode(docs, vocabulary), vocabulary).count() == 0
    records.write_records(docs, vocabulary, str(tmp_path / "none"))
    assert records.write_index(spark, str(tmp_path / "none")).count() == 0


def test_decode_of_odd_ids(spark, library, vocabulary):
    rows = [(1, [15496, 50256, 995]), (2, None), (3, []), (4, [-5, 999_999, 15496]), (5, [30325])]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary).collect()}
    assert got[1] == library.decode([15496, 50256, 995], skip_special_tokens=False)
    assert (got[2], got[3], got[4]) == ("", "", library.decode([15496]))
    assert got[5] == library.decode([30325], skip_special_tokens=False)


def test_other_kinds_of_file_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.int64) - 2, np.zeros(0, np.uint32), np.array([1, 255], np.uint8), np.array([70000, 3], np.int32)]
    for a, b in zip(arrays, blocks.unpack(blocks.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_records_hold_all_ids_in_order(spark, stored_docs, edge_rows, library, vocabulary, tmp_path):
    path = str(tmp_path / "records")
    records.write_records(stored_docs(edge_rows), vocabulary, path, end_id=2, records_per_file=7)
    index = sorted(records.write_index(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in index]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in index:
        assert r.start == at
        at += r.n_tokens
    expected = sorted((str(i), zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, t in edge_rows)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in index) == expected
    some = spark.read.parquet(f"{path}/index").where("doc_id % 2 = 1")
    read = records.read_records(spark, path, some).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in read) == sorted((r.doc_id, r.n_tokens) for r in some.collect())


def test_wrong_bytes_are_found():
    data = bytearray(records.frame(5, np.array([1, 2, 3], np.uint32), False) + b"\n")
    assert records.parse(bytes(data), 0)[0] == 5
    for k in range(len(data) - 1):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(Exception):  # noqa: B017
            records.parse(bytes(broken), 0)
