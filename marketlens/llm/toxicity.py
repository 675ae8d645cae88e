"""Toxicity scores of texts whose words may be disguised.

Disguised spans (digits and signs for letters, letters set apart, letters
repeated) become lattices of what each sign may stand for; a character
language model, counted over all documents, finds the likeliest reading
through a lattice (Viterbi).  The restored text is scored by a lexicon learned
from marked documents: whole words and word beginnings that, one after the
other, explain most of the toxic documents still unexplained.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_batches

#: Letters that a sign may stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e"}
#: Channel: log probabilities that a sign stands for a letter or only for itself, that a gap inside letters set apart
#: is none or ends a word, that a repeated letter is meant once or twice.
SIGN, ITSELF = math.log(0.8), math.log(0.02)
NO_GAP, GAP = math.log(0.9), math.log(0.1)
ONCE, TWICE = math.log(0.6), math.log(0.4)
SIGNS = re.escape("".join(STANDS_FOR))
#: Spans that may be disguised: letters set apart, a sign before or between letters, a letter three times or two letters twice.
SPAN = re.compile(
    rf"(?<![^\W_{SIGNS}])(?<![{SIGNS}])[a-z{SIGNS}](?:[ .*_-][a-z{SIGNS}]){{2,}}(?![^\W_]|[{SIGNS}])"
    rf"|(?<![a-z{SIGNS}])[a-z]*+[{SIGNS}][a-z{SIGNS}]*+"
    r"|(?<![a-z])[a-z]*?([a-z])\1(?:\1|[a-z]*?([a-z])\2)[a-z]*")
APART = re.compile(r"[ .*_-]")
WORD = re.compile(r"[^\W\d_]+")
#: Letters besides a-z that fold to letters of a-z.
FOLD = {c: b for c in range(0xC0, 0x250) if (b := "".join(x for x in unicodedata.normalize("NFD", chr(c).lower()) if "a" <= x <= "z"))} | {0xDF: "ss", 0xE6: "ae", 0xF8: "o", 0x153: "oe"}
LETTERS = 27                 # a to z, and 0 for the end of a word
PIECE = 4096                 # longer spans are read in pieces
REMEMBERED = 200_000         # spans, and words, that a task remembers at a time
BEGINNINGS = (4, 5, 6, 7)    # bytes
CODE = np.zeros(256, np.uint8)
CODE[97:123] = np.arange(1, 27)


def folded(text: str) -> str:
    """Lower case, letters with marks without them."""
    low = text.lower()
    return low if low.isascii() else low.translate(FOLD)


# --- character language model --------------------------------------------------


def grams(text: bytes) -> np.ndarray:
    """Numbers of the 4-grams within words (what precedes a word counts as 0)."""
    c = np.concatenate([np.zeros(3, np.uint8), CODE[np.frombuffer(text, np.uint8)], np.zeros(1, np.uint8)]).astype(np.int32)
    now, one = c[3:], c[2:-1]
    two = np.where(one > 0, c[1:-2], 0)
    three = np.where(two > 0, c[:-3], 0)
    return (((three * LETTERS + two) * LETTERS + one) * LETTERS + now)[(now > 0) | (one > 0)]


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a letter (or the word's end) after the three before it, counted over all texts.

    At most 27^4 sums reach the driver, whatever the corpus.
    """
    size = LETTERS**4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(grams(" ".join(folded(t) for t in b.column(0).to_pylist() if t).encode("ascii", "replace")), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    found = map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size)
    counts[found.gram.to_numpy(np.int64)] = found.n.to_numpy(np.float64)
    return smoothed(counts.reshape((LETTERS,) * 4))


def smoothed(counts: np.ndarray, strength: float = 3.0) -> np.ndarray:
    """Each order is mixed with the next shorter one."""
    p = (counts.sum((0, 1, 2)) + 1) / (counts.sum() + LETTERS)
    for skip in (2, 1, 0):
        c = counts.sum(tuple(range(skip))) if skip else counts
        p = (c + strength * p) / (c.sum(-1, keepdims=True) + strength)
    return np.log(p).astype(np.float32)


# --- noisy channel -------------------------------------------------------------


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each place of a span what it may mean, with its log probability."""
    out, i, apart = [], 0, len(APART.split(span)) > 2 and all(len(x) < 2 for x in APART.split(span))
    while i < len(span):
        sign = span[i]
        if sign in STANDS_FOR:
            out.append([(c, SIGN - math.log(len(STANDS_FOR[sign]))) for c in STANDS_FOR[sign]] + [(" ", ITSELF)])
            i += 1
        elif apart and not "a" <= sign <= "z":
            out.append([("", NO_GAP), (" ", GAP)])
            i += 1
        else:
            k = i + 1
            while k < len(span) and span[k] == sign:
                k += 1
            out.append([(sign, 0.0)] if k == i + 1 else [(sign, ONCE), (sign * 2, TWICE)])
            i = k
    return out


class Reader:
    """Readings of disguised spans under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = array("f", model.reshape(-1).tobytes())
        self.known: dict[str, str] = {}

    def read(self, span: str) -> str:
        """The likeliest reading of a lattice."""
        best = {0: (0.0, None)}                     # by the last three letters: log probability, (letters, what came before)
        for options in lattice(span):
            then: dict[int, tuple] = {}
            for context, (p, before) in best.items():
                for letters, own in options:
                    q, at = p + own, context
                    for c in letters:
                        code = 0 if c == " " else ord(c) - 96
                        if code or at:
                            q += self.model[at * LETTERS + code]
                        at = (at * LETTERS + code) % LETTERS**3 if code else 0
                    if at not in then or then[at][0] < q:
                        then[at] = (q, (letters, before))
            best = then
        _, way = max(((p + (self.model[at * LETTERS] if at else 0.0), way) for at, (p, way) in best.items()), key=lambda x: x[0])
        out = []
        while way is not None:
            out.append(way[0])
            way = way[1]
        return "".join(reversed(out))

    def __call__(self, match: re.Match) -> str:
        span = match.group()
        bare = span.rstrip("@$!|+€")                # signs behind the last letter are punctuation
        if sum("a" <= c <= "z" for c in bare) < 2 and len(bare) < 5 or bare.isdecimal():
            return span
        found = self.known.get(bare)
        if found is None:
            found = "".join(self.read(bare[i:i + PIECE]) for i in range(0, len(bare), PIECE))
            if len(bare) < 100:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known[bare] = found
        return found + " " * (len(span) > len(bare))

    def restored(self, text: str) -> str:
        """A text in lower case with its disguised spans read."""
        return SPAN.sub(self, text.lower())


#: How often a word beginning comes: at least so many times, or in so many words of a hundred.
TIMES, SHARES = (2, 4), (0.5, 1, 2)


def leveled(starts: dict[int, int], size: int) -> set[int]:
    """Numbers of word beginnings, and of how often they come in a text of ``size`` words."""
    out = set(starts)
    for number, n in starts.items():
        if n > 1:
            out.update(number ^ (level << 24) for level, least in enumerate(TIMES, 1) if n >= least)
            out.update(number ^ (level << 24) for level, share in enumerate(SHARES, 1 + len(TIMES)) if 100 * n >= share * size)
    return out


def numbers_of(word: str) -> tuple[int, list[int]]:
    """The number (crc32) of a whole word, and those of its beginnings."""
    raw = word.encode("utf-8", "replace")
    return zlib.crc32(raw, 1), [zlib.crc32(raw[:k]) for k in BEGINNINGS if len(raw) >= k]


def terms(text: str) -> set[int]:
    """Numbers of a restored text's words and word beginnings, and of how often these come."""
    counts = Counter(WORD.findall(text))
    out, starts = set(), Counter()
    for word, n in counts.items():
        whole, begins = numbers_of(word)
        out.add(whole)
        for number in begins:
            starts[number] += n
    return out | leveled(starts, counts.total())


class Watch:
    """The terms of texts that are in a lexicon; remembers words."""

    def __init__(self, wanted: set[int]):
        self.wanted = wanted
        self.near = {t ^ (level << 24) for t in wanted for level in range(1 + len(TIMES) + len(SHARES))}
        self.known: dict[str, tuple[int, list[int]] | None] = {}

    def terms(self, text: str) -> set[int]:
        words = WORD.findall(text)
        known, near, held, starts = self.known, self.near, set(), Counter()
        for word in words:
            hit = known.get(word, 0)
            if hit is None:
                continue
            if hit == 0:
                whole, begins = numbers_of(word)
                begins = [b for b in begins if b in near]
                hit = (whole, begins) if begins or whole in near else None
                if len(known) > REMEMBERED:
                    known.clear()
                known[word] = hit
                if hit is None:
                    continue
            held.add(hit[0])
            for number in hit[1]:
                starts[number] += 1
        return (held | leveled(starts, len(words))) & self.wanted


# --- lexicon -------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """Of each term its weight and, if no clean marked text holds it, the share of toxic texts among those that do (else 0)."""

    weights: dict[int, tuple[float, float]]
    bias: float
    model: np.ndarray

    def score(self, found: set[int]) -> float:
        """By the weights of all terms found, and no less than the share of the most telling one."""
        held = [self.weights[t] for t in found]
        z = self.bias + sum(w for w, _ in held)
        return max([1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), *(share for _, share in held)])


def chosen_terms(found: list[np.ndarray], toxic: np.ndarray, against: float = 4.0, alike: float = 0.6, most: int = 500) -> list[int]:
    """Terms of toxic texts, those in most of them (less ``against`` times the clean ones) first.

    A term must be in so many toxic texts that, by the share of toxic ones,
    chance alone would give no term such a record.  A term that is in about
    the same toxic texts as a chosen one is passed over.
    """
    if not toxic.any() or toxic.all():
        return []
    values, numbers = np.unique(np.concatenate(found), return_inverse=True)
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    held = np.bincount(numbers[toxic[owner]], minlength=len(values))
    clean = np.bincount(numbers[~toxic[owner]], minlength=len(values))
    having = np.cumsum(np.bincount(held + clean, minlength=len(found) + 1)[::-1])[::-1]
    chance = having * toxic.mean() ** np.arange(len(having))
    gain = held - against * clean
    able = np.flatnonzero(gain >= max(3, int((chance >= 0.1).sum())))
    order = able[np.argsort(-gain[able], kind="stable")]
    place = np.full(len(values), -1)
    place[order] = np.arange(len(order))
    marked = np.flatnonzero(toxic)
    in_text = np.zeros((len(order), len(marked)), bool)
    mine = toxic[owner] & (place[numbers] >= 0)
    in_text[place[numbers[mine]], np.searchsorted(marked, owner[mine])] = True
    out: list[int] = []
    for i in range(len(order)):
        if len(out) == most:
            break
        both = (in_text[out] & in_text[i]).sum(1)
        if not (both > alike * (in_text[out] | in_text[i]).sum(1)).any():
            out.append(i)
    return values[order[out]].tolist()


def fit(found: list[np.ndarray], toxic: np.ndarray, model: np.ndarray, steps: int = 600, l2: float = 1e-5) -> Lexicon:
    """Logistic weights of the chosen terms; without marks of both kinds every score is 0."""
    if not len(toxic) or not toxic.any() or toxic.all():
        return Lexicon({}, -30.0 if not toxic.any() else 30.0, model)
    lexicon = chosen_terms(found, toxic)
    x = np.array([[t in own for t in lexicon] for own in (set(f.tolist()) for f in found)], np.float64).reshape(len(found), len(lexicon))
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        g = x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - toxic) / len(x) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    held, clean = x[toxic, :-1].sum(0), x[~toxic, :-1].sum(0)
    share = np.where(clean == 0, (held + 0.5) / (held + 1), 0)
    return Lexicon(dict(zip(lexicon, zip(w[:-1].tolist(), share.tolist()))), float(w[-1]), model)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000) -> Lexicon:
    """The character model of all texts, and a lexicon from at most ``max_labelled`` marked ones (columns doc_id, toxic).

    The marked rows are taken in the order of a hash of their id; rows
    without an id or with another mark than 0 or 1 are ignored, an id marked
    twice counts as its larger mark, equal texts count once (as the larger
    mark), and of several texts under one id all count.  About 3 KB for each
    marked text reach the driver.
    """
    model = language_model(docs)
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("mark"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(marked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            numbers = [np.array(sorted(terms(reader.restored(t))), np.uint32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(map(sketch, texts), pa.list_(pa.int64())), b.column(0), pa.array(numbers, pa.binary())], names=["sketch", "mark", "terms"])

    found = map_batches(rows.select("mark", "text"), run, "sketch array<long>, mark int, terms binary").toPandas()
    found["sketch"] = found.sketch.map(tuple)
    found = found.sort_values(["mark", "sketch", "terms"], ascending=[False, True, True])
    seen: set[tuple] = set()
    kept = []
    for own in found.sketch:
        kept.append(not any(x in seen for x in enumerate(own)))
        seen.update(enumerate(own))
    found = found[np.array(kept, bool)]
    return fit([np.frombuffer(t, np.uint32) for t in found.terms], found.mark.to_numpy() == 1, model)


def sketch(text: str) -> list[int]:
    """Four least hashes of a text's three-word runs: near copies share one almost surely, other texts none."""
    words = text.encode("utf-8", "replace").split()
    hashes = np.array([zlib.crc32(b" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))], np.uint64)
    return [int(((hashes * np.uint64(k)) & np.uint64(0xFFFFFFFF)).min()) for k in (1, 2654435761, 40503 * 65537, 2246822519)]


def score(docs: DataFrame, lexicon: Lexicon, *kept: str | Column) -> DataFrame:
    """``doc_id`` (and the columns ``kept``), ``score`` 0 to 1 and ``predicted`` of every whole text.

    Null and empty texts get the score of a text without known terms; null
    and repeated ids are carried row by row; other columns are ignored; an
    empty table gives no rows.
    """
    own = docs.select("doc_id", *kept, F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text_to_score_"))
    at = len(own.columns) - 1
    shape = own.drop("text_to_score_").withColumns({"score": F.lit(0.0).cast("double"), "predicted": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, watch = Reader(lexicon.model), Watch(set(lexicon.weights))
        for b in batches:
            s = np.array([lexicon.score(watch.terms(reader.restored(t))) for t in b.column(at).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*b.schema.names[:at], "score", "predicted"])

    return map_batches(own, run, shape)
