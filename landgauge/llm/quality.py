"""Text quality by a factorisation machine.

Features are hashed lower-cased words, with their share of the text as value, and structure statistics and the
length given as metadata, each as one of eight bins (cut at quantiles of the training rows) with value 1. The
score is a logistic function of a linear part and all pairwise interactions, which share low-rank factors;
their sum is had in linear time as half the square of the sum less the sum of the squares, per factor.

The model is fitted on the driver by Adagrad on at most ``limit`` labelled rows (8,192 unless told otherwise); every
document is scored whole. Null and empty texts have no words and only their statistics count. Nulls in the
length count as the length of the text. Without any labelled row every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from landgauge.llm import bytesops as B
from landgauge.llm.common import lists, mapped, pieces, table, utf8
from landgauge.llm.labelled import training_rows

BUCKETS = 1 << 16
BINS = 8
RANK = 8

#: Kinds of bytes; 5 is none of them.
_KIND = np.full(256, 5, np.uint8)
_KIND[65:91] = 0  # capital letters
_KIND[48:58] = 1  # digits
_KIND[[33, 35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 124, 126]] = 2  # signs that are rare in prose
_KIND[[44, 46, 58, 59, 63, 34, 39, 40, 41, 45]] = 3  # punctuation of prose
_KIND[128:] = 4  # bytes of non-ASCII characters
STATS = 12


def sums_by(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def held(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    return np.diff(np.searchsorted(np.flatnonzero(marked), offsets))


def features(b: pa.RecordBatch):
    """Distinct words as (row, bucket, share), and the statistics of each row."""
    buf, offsets = utf8(b.column("text"))
    n, size = b.num_rows, np.diff(offsets).astype(float)
    starts, ends = B.word_bounds(~B.BLANK[buf], offsets)
    row = B.rows_of(starts, offsets)
    low = B.LOWER[buf]
    hashes = B.range_hash(B.prefix_sums(low), starts, ends, low)
    words = np.bincount(row, minlength=n).astype(float)
    # Words of a row, sorted by bucket: equal neighbours are counted.
    key = np.sort((row.astype(np.uint64) << np.uint64(16)) | (hashes >> np.uint64(48)))
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    count = np.diff(np.append(new, len(key)))
    at, bucket = (key[new] >> np.uint64(16)).astype(np.int64), (key[new] & np.uint64(0xFFFF)).astype(np.int64)
    share = count / np.maximum(words[at], 1)
    some, full = np.maximum(words, 1), np.maximum(size, 1)
    stats = np.empty((n, STATS))
    kinds = _KIND[buf]
    for i in range(5):
        stats[:, i] = held(kinds == i, offsets) / full
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1]))[: len(row)]
    stats[:, 5] = sums_by(again, row, n) / some
    stats[:, 6] = np.bincount(at, minlength=n) / some
    top = np.zeros(n)
    np.maximum.at(top, at, share)
    stats[:, 7] = top
    stats[:, 8] = sums_by(ends - starts, row, n) / some
    stats[:, 9] = np.log1p(words)
    stats[:, 10] = (1 + held(buf == 10, offsets)) / some
    given = b.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)
    stats[:, 11] = np.log1p(np.clip(np.where(np.isnan(given), size, given), 0, None))
    return at, bucket, share, stats


class FactorisationMachine:
    def __init__(self, cuts: np.ndarray, seed: int = 7):
        size = BUCKETS + STATS * BINS
        self.cuts, self.bias = cuts, 0.0
        self.linear = np.zeros(size, np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.01, (size, RANK)).astype(np.float32)

    def inputs(self, at, bucket, share, stats):
        """All features of all rows as (row, feature, value), by row."""
        n = len(stats)
        bins = np.stack([np.searchsorted(c, stats[:, i], side="right") for i, c in enumerate(self.cuts)], 1)
        ids = BUCKETS + np.arange(STATS) * BINS + bins
        row = np.concatenate([at, np.repeat(np.arange(n), STATS)])
        order = np.argsort(row, kind="stable")
        feature = np.concatenate([bucket, ids.ravel()])[order]
        value = np.concatenate([np.sqrt(share), np.ones(n * STATS)])[order].astype(np.float32)
        return row[order], feature, value

    def raw(self, row, feature, value, n):
        starts = np.searchsorted(row, np.arange(n))
        scaled = self.factors[feature] * value[:, None]
        total = np.add.reduceat(scaled, starts) if n else np.zeros((0, RANK), np.float32)
        squares = np.add.reduceat(np.square(scaled).sum(1), starts) if n else np.zeros(0)
        line = np.add.reduceat(self.linear[feature] * value, starts) if n else np.zeros(0)
        return self.bias + line + 0.5 * (np.square(total).sum(1) - squares), total

    def scores(self, b: pa.RecordBatch) -> np.ndarray:
        raw, _ = self.raw(*self.inputs(*features(b)), b.num_rows)
        return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))

    @classmethod
    def fit(cls, row, bucket, share, stats, y, epochs: int = 12, batch: int = 256, rate: float = 0.08):
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        fm = cls(np.stack([np.quantile(stats[:, i], quantiles) for i in range(STATS)]))
        row, feature, value = fm.inputs(row, bucket, share, stats)
        starts = np.searchsorted(row, np.arange(len(y) + 1))
        g_line, g_factor = np.full(len(fm.linear), 1e-3), np.full(fm.factors.shape, 1e-3)
        rng = np.random.default_rng(11)
        fm.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        for _ in range(epochs):
            shuffled = rng.permutation(len(y))
            for k in range(0, len(y), batch):
                rows = shuffled[k : k + batch]
                sizes = starts[rows + 1] - starts[rows]
                own = B.ranges(starts[rows], sizes)
                r, f, x = np.repeat(np.arange(len(rows)), sizes), feature[own], value[own]
                raw, total = fm.raw(r, f, x, len(rows))
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) / len(rows)
                slope = error[r] * x
                used, inverse = np.unique(f, return_inverse=True)
                line = np.bincount(inverse, weights=slope) + 1e-5 * fm.linear[used]
                each = slope[:, None] * (total[r] - fm.factors[f] * x[:, None])
                factor = np.stack([np.bincount(inverse, weights=each[:, d]) for d in range(RANK)], 1) + 1e-5 * fm.factors[used]
                g_line[used] += line**2
                g_factor[used] += factor**2
                fm.linear[used] -= (rate * line / np.sqrt(g_line[used])).astype(np.float32)
                fm.factors[used] -= (rate * 0.3 * factor / np.sqrt(g_factor[used])).astype(np.float32)
                fm.bias -= rate * float(error.sum())
        return fm


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, limit: int = 8192):
    """The fitted machine, or None without labelled rows."""
    rows = training_rows(docs.select("doc_id", "text", "n_chars"), labels, label, folds, held_out, limit)
    kind = [("y", pa.int32()), ("bucket", pa.list_(pa.int32())), ("share", pa.list_(pa.float64())), ("stats", pa.list_(pa.float64()))]

    def extract(batches):
        for b in pieces(batches):
            at, bucket, share, stats = features(b)
            n = np.bincount(at, minlength=b.num_rows)
            each = np.full(b.num_rows, STATS)
            yield table(kind, b.column("y"), lists(bucket, n, pa.int32()), lists(share, n, pa.float64()), lists(stats.ravel(), each, pa.float64()))

    got = mapped(rows, extract, "y int, bucket array<int>, share array<double>, stats array<double>").toArrow()
    if got.num_rows == 0:
        return None
    flat = {c: got[c].combine_chunks() for c in got.column_names}
    row = np.repeat(np.arange(got.num_rows), flat["bucket"].value_lengths().to_numpy())
    stats = flat["stats"].flatten().to_numpy().reshape(-1, STATS)
    return FactorisationMachine.fit(
        row, flat["bucket"].flatten().to_numpy(), flat["share"].flatten().to_numpy(), stats, flat["y"].to_numpy().astype(float)
    )


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, names=("score", "predicted"), **fit) -> DataFrame:
    """``docs`` as they are, with score and predicted added at the end under ``names`` (their own of these names go)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_quality(docs, labels, **fit))  # of fixed size
    docs = docs.drop(*names)
    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def score(batches):
        fm = model.value
        for b in pieces(batches):
            s = fm.scores(b) if fm is not None else np.full(b.num_rows, 0.5)
            columns = [*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, *names])

    return mapped(docs, score, schema)
