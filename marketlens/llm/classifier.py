"""Quality scores by Bradley-Terry pairwise ranking.

Preference pairs (a document marked 1 over one marked 0) are fitted by
logistic loss on the difference of their features; a score quantile then
splits the ranking into accepted and rejected documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import SPACES, map_batches

BINS = 256
#: Marks whose rate per character is a feature of its own.
MARKS = (b"!", b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b".", b",", b"@", b"=", b"\n")
N_STYLE = 12 + len(MARKS)
N_FEATURES = N_STYLE + 2 * BINS


def features(text: bytes | None) -> np.ndarray:
    """Style rates, byte shares and hashed byte-pair shares of a whole text (zeros for an empty one)."""
    x = np.zeros(N_FEATURES, np.float32)
    size = len(text or b"")
    if not size:
        return x
    raw = np.frombuffer(text, np.uint8)
    hist = np.bincount(raw, minlength=256)
    words = text.split()
    n = max(1, len(words))
    lines = [y for y in text.split(b"\n") if y and not y.isspace()]
    m = max(1, len(lines))
    upper, lower, digits = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    x[:12] = (
        np.log1p(n) / 10,
        np.log1p(size) / 12,
        upper / max(1, upper + lower),
        digits / size,
        hist[128:].sum() / size,
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n,
        (size - hist[list(SPACES)].sum()) / n / 20,
        len(set(lines)) / m,
        sum(y.rstrip().endswith((b".", b"!", b"?")) for y in lines) / m,
        n / m / 50,
        text.count(b"!!") / n,
    )
    x[12:N_STYLE] = [min(1.0, 5 * hist[c[0]] / n) for c in MARKS]
    x[N_STYLE:N_STYLE + BINS] = np.sqrt(hist / size)
    if size > 1:
        pairs = (raw[:-1].astype(np.uint32) * 40503 + raw[1:].astype(np.uint32) * 30011) >> 5
        x[N_STYLE + BINS:] = np.sqrt(np.bincount(pairs & (BINS - 1), minlength=BINS) / (size - 1))
    return x


@dataclass(frozen=True)
class Ranker:
    """Fitted weights; ``threshold`` is the score quantile that splits accepted from rejected."""

    weights: np.ndarray
    mean: np.ndarray
    threshold: float
    scale: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = (x - self.mean) @ self.weights
        return 1 / (1 + np.exp(-np.clip((raw - self.threshold) / self.scale, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 400, pairs: int = 4096, l2: float = 1e-4, seed: int = 7) -> Ranker:
    """Bradley-Terry: P(a over b) = sigmoid(w.(x_a - x_b)), by Adam on drawn preference pairs."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):                            # no preference can be learned
        return Ranker(np.zeros(N_FEATURES), np.zeros(N_FEATURES), 0.0, 1.0)
    mean, spread = x.mean(0), x.std(0) + 0.02
    z = (x - mean) / spread
    rng = np.random.default_rng(seed)
    w, m, v = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for t in range(1, steps + 1):
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        g = -(d * (1 / (1 + np.exp(np.clip(d @ w, -30, 30))))[:, None]).mean(0) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    raw = z @ w
    share = len(bad) / len(y)
    # The quantile that the rejected share names, set in the middle of the gap around it.
    low, high = np.quantile(raw, [max(0.0, share - 0.005), min(1.0, share + 0.005)])
    return Ranker(w / spread, mean, float((low + high) / 2), float(max(1e-6, raw.std() / 4)))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_labelled`` rows, taken in the order of a hash of their id.

    The bound (a parameter) keeps what reaches the driver at about
    2 KB times ``max_labelled``.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
              .groupBy("doc_id").agg(F.max("quality").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t).tobytes() for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int32()), pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])

    found = (map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
             .dropDuplicates(["doc_id"]).select("doc_id", "label", "text"), run, "doc_id long, label int, x binary").toPandas().sort_values("doc_id"))
    if not len(found):
        return np.zeros((0, N_FEATURES)), np.zeros(0)
    return np.vstack([np.frombuffer(v, np.float32) for v in found.x]).astype(np.float64), found.label.to_numpy()


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> Ranker:
    """Fit on at most ``max_labelled`` of ``labels`` (doc_id, quality), joined to their texts.

    Rows without an id or with another mark than 0 or 1 are ignored; an id
    marked twice counts as its larger mark; without both marks every score
    is one half.
    """
    return fit(*labelled_sample(docs, labels, max_labelled))


def score(docs: DataFrame, ranker: Ranker, keep: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and the columns named in ``keep``), ``score`` 0 to 1 and ``predicted``, row by row.

    Null and empty texts get the score of zero features; null and repeated
    ids are carried through; other columns are ignored; an empty table gives
    an empty result.  The score is one half at the ranker's quantile.
    """
    kept = ["doc_id"] if keep is None else keep
    shape = docs.select(*kept, F.lit(0.0).cast("double").alias("score"), F.lit(0).alias("predicted")).schema
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            s = ranker.scores(np.vstack([features(t) for t in b.column(at).cast(pa.binary()).to_pylist()]).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(at)] + [pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*kept, "score", "predicted"])

    return map_batches(docs.select(*kept, docs["text"].cast("string").alias("text_to_score_")), run, shape)
