"""Line-first quality rules.

Every line of a text is judged on its own: lines without closing
punctuation, navigation bars and boilerplate are removed, then a document is
rejected when too few of its words are left.  One pass over the documents,
no shuffle; a text is the largest thing a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlens.llm.common import SPACES, map_batches

SYMBOLS = b"#*$%&|<>"
#: Bytes that may close a sentence, after trailing quotes and brackets are taken off.
CLOSERS = (b".", b"!", b"?", b":", b";", "…".encode(), "。".encode(), "！".encode(), "？".encode(), "؟".encode(), "।".encode())
INNER_CLOSERS = (b". ", b"! ", b"? ", b".\" ", "。".encode())   # prose that is cut off later on
QUOTES = b"\"')]} \t\x0b\x0c\r" + "”’»".encode()
#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    b"lorem ipsum", b"cookie policy", b"privacy policy", b"terms of use", b"terms of service",
    b"all rights reserved", b"enable javascript", b"use cookies", b"skip to content", b"sign up for our newsletter",
)
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_removed_lines long, left_words long")


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the document verdict."""

    nav_separators: int = 2       # a line with this many | » › or > between short labels is a navigation bar
    nav_words: float = 3.0        # ... when its labels have at most so many words on average
    max_symbols: float = 0.1      # symbols of SYMBOLS per character of a line
    max_bangs: float = 0.3        # !! per word of a line
    min_left: float = 0.5         # share of the words that must be left


def line_ok(line: bytes, rules: Rules) -> bool:
    """Whether a line that has a word passes the punctuation, navigation and boilerplate rules."""
    if not line.rstrip(QUOTES).endswith(CLOSERS) and not any(c in line for c in INNER_CLOSERS):
        return False
    size = len(line)
    symbols = size - len(line.translate(None, SYMBOLS))
    if symbols > rules.max_symbols * size:
        return False
    bars = line.count(b"|") + line.count("»".encode()) + line.count("›".encode()) + line.count(b" > ")
    if bars >= rules.nav_separators and len(line.split()) <= (bars + 1) * (rules.nav_words + 1):
        return False
    if b"!!" in line and line.count(b"!!") > rules.max_bangs * len(line.split()):
        return False
    low = line.lower()
    return not any(p in low for p in BOILERPLATE)


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more (the first occurrence included)."""
    n = len(words)
    if n < 4 or len(set(zip(words, words[1:], words[2:]))) == n - 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]   # keeps the next key within 64 bits
    _, inverse, counts = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] >= 2
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def judge(text: bytes | None, rules: Rules) -> tuple[tuple, list[bytes]]:
    """The result columns behind doc_id, and the lines that are left."""
    text = text or b""
    words = text.split()
    n = len(words)
    solid = len(text) - len(text.translate(None, SPACES))                   # separators, one byte each
    word_chars = len(text.decode("utf-8", "replace")) - solid
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    left: list[bytes] = []
    dups = removed = lost = 0
    for line in lines:
        if not line or line.isspace():
            left.append(line)
            continue
        dup = line in seen
        seen.add(line)
        dups += dup
        if dup or not line_ok(line, rules):                                  # a repeated line is boilerplate
            removed += 1
            lost += len(line.split())
        else:
            left.append(line)
    repeats = repeat_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    kept = not failed and n - lost >= rules.min_left * n
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (n, word_chars, symbols, dups, repeats, failed, kept, len(lines), removed, n - lost), left


def apply_rules(docs: DataFrame, rules: Rules = Rules(), with_text: bool = False) -> DataFrame:
    """Judge every text line by line, then as a document.

    Takes ``doc_id`` and ``text`` (other columns, whatever their names, are
    ignored) and returns one row per input row: the base counts, the verdict
    ``kept``, and the numbers of lines and words left; ``with_text`` adds
    ``clean_text``.  A null text counts as empty and an empty text fails the
    base rule; null and repeated ids are carried through row by row; a
    repeated line counts as removed from its second occurrence on.  An empty
    table gives an empty result.
    """
    schema = SCHEMA + (", clean_text string" if with_text else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, rules) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = [batch.column(0)] + [pa.array([r[0][k] for r in rows], pa.bool_() if k in (5, 6) else pa.int64()) for k in range(10)]
            if with_text:
                columns.append(pa.array([b"\n".join(r[1]) for r in rows], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ids = docs["doc_id"].cast("long").alias("doc_id")
    return map_batches(docs.select(ids, docs["text"].cast("string").alias("text")), run, schema)
