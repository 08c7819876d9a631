"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability (logistic, over hashed words and word
beginnings), and a document's is the noisy-or of its sentences': it is toxic unless none of them is. Only
document labels are needed for training; afterwards the sentences that carry the probability are the offending ones.

The weights are fitted on the driver on at most ``limit`` labelled rows (4,096 unless told otherwise), over features
that at least ``SEEN`` training documents have. Every document is scored whole. A text without words scores 0. Without
any labelled row all scores are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from landgauge.llm import bytesops as B
from landgauge.llm.common import lists, mapped, pieces, table, utf8
from landgauge.llm.labelled import training_rows

BITS = 18
#: Beginnings of words that are features beside the whole word, in bytes.
BEGINNINGS = (4, 5, 6)
SEEN = 5

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True  # line feed ! . ?


def sentences(buf: np.ndarray, offsets: np.ndarray):
    """Words as hashed features (one column per kind) with the sentence of each; starts of the sentences."""
    starts, ends = B.word_bounds(_LETTER[buf], offsets)
    opens = np.zeros(len(buf) + 1, bool)
    opens[offsets[:-1]] = True
    opens[1:][_END[buf]] = True
    at = np.flatnonzero(opens[: len(buf)])
    sentence = np.searchsorted(at, starts, side="right") - 1
    sums = B.prefix_sums(B.LOWER[buf])
    kinds = [B.range_hash(sums, starts, ends)]
    for k in BEGINNINGS:
        # A beginning counts only where the word goes on.
        h = B.range_hash(sums, starts, np.minimum(starts + k, ends)) + np.uint64(k)
        kinds.append(np.where(ends - starts > k, h * np.uint64(B.STEP), kinds[0]))
    ids = np.stack([(h >> np.uint64(64 - BITS)).astype(np.int32) for h in kinds], 1)
    return ids, sentence, at


class NoisyOr:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, buf, offsets):
        """Probability of each document; of each sentence; starts and documents of the sentences."""
        n = len(offsets) - 1
        ids, sentence, at = sentences(buf, offsets)
        raw = np.bincount(sentence, weights=self.weights[ids].sum(1), minlength=len(at)) + self.bias
        worded = np.bincount(sentence, minlength=len(at)) > 0
        p = np.where(worded, 1 / (1 + np.exp(-np.clip(raw, -30, 30))), 0.0)
        row = B.rows_of(at, offsets)
        none = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
        return -np.expm1(none), p, at, row

    @classmethod
    def fit(cls, ids, sentence, bag, y, epochs: int = 100, rate: float = 0.05, decay: float = 1e-2):
        """ids: features of all words; sentence: of each word; bag: document of each sentence."""
        size = 1 << BITS
        # One pass per kind of feature keeps the sorted pairs of document and feature small.
        documents, toxic = np.zeros(size, np.int64), np.zeros(size, np.int64)
        seen_pairs = np.unique(np.concatenate([np.unique(bag[sentence] << BITS | ids[:, k]) for k in range(ids.shape[1])]))
        documents += np.bincount(seen_pairs & (size - 1), minlength=size)
        toxic += np.bincount((seen_pairs & (size - 1))[y[seen_pairs >> BITS] > 0], minlength=size)
        del seen_pairs
        seen = documents >= SEEN
        names = np.flatnonzero(seen)
        place = np.cumsum(seen, dtype=np.int32) - 1
        used = [seen[ids[:, k]] for k in range(ids.shape[1])]
        flat = np.concatenate([place[ids[u, k]] for k, u in enumerate(used)])
        owner = np.concatenate([sentence[u].astype(np.int32) for u in used])
        del used
        # The start: features that toxic documents have clearly more often get their log-odds, shared by the word's kinds.
        share = y.mean()
        n, n1 = documents[names], toxic[names]
        odds = np.log((n1 + 0.5) / (n - n1 + 0.5)) - np.log((share + 1e-9) / (1 - share + 1e-9))
        clear = n1 - n * share > 3 * np.sqrt(n * share * (1 - share) + 1)
        w, bias = np.where(clear, np.maximum(odds, 0), 0.0) / 2, -6.0
        m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
        for step in range(1, epochs + 1):
            raw = np.bincount(owner, weights=w[flat], minlength=len(bag)) + bias
            p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            none = np.exp(np.bincount(bag, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)))
            # Descent on the log-loss of the noisy-or: a positive bag pulls its sentences by their share of it.
            pull = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0)[bag] * p / len(y)
            g = np.append(np.bincount(flat, weights=pull[owner], minlength=len(names)) + decay * w / len(y) * 50, pull.sum())
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g * g
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            w -= move[:-1]
            bias -= 0.2 * move[-1]
        weights = np.zeros(size, np.float32)
        weights[names] = w
        return cls(weights, bias)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held_out: int = 2, limit: int = 4096):
    rows = training_rows(docs.select("doc_id", "text"), labels, label, folds, held_out, limit)
    kind = [("y", pa.int32()), ("ids", pa.list_(pa.int32())), ("sentence", pa.list_(pa.int32())), ("sentences", pa.int32())]

    def extract(batches):
        for b in pieces(batches):
            buf, offsets = utf8(b.column("text"))
            ids, sentence, at = sentences(buf, offsets)
            owner = B.rows_of(at, offsets)
            n = np.bincount(owner, minlength=b.num_rows)
            row = owner[sentence]
            words = np.bincount(row, minlength=b.num_rows)
            local = sentence - (np.cumsum(n) - n)[row]
            yield table(kind, b.column("y"), lists(ids.ravel(), words * ids.shape[1], pa.int32()), lists(local, words, pa.int32()), n)

    got = mapped(rows, extract, "y int, ids array<int>, sentence array<int>, sentences int").toArrow()
    if got.num_rows == 0:
        return None
    flat = {c: got[c].combine_chunks() for c in got.column_names}
    n = flat["sentences"].to_numpy().astype(np.int64)
    words = flat["sentence"].value_lengths().to_numpy()
    sentence = flat["sentence"].flatten().to_numpy() + np.repeat(np.cumsum(n) - n, words)
    ids = flat["ids"].flatten().to_numpy().reshape(-1, 1 + len(BEGINNINGS))
    del got
    return NoisyOr.fit(ids, sentence, np.repeat(np.arange(len(n)), n), flat["y"].to_numpy().astype(float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, offending: float = 0.2, **fit) -> DataFrame:
    """Per document: doc_id, score, predicted, offending (the sentences of at least that probability)."""
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, **fit))  # of fixed size
    kind = [("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("offending", pa.list_(pa.string()))]

    def score(batches):
        m = model.value
        for b in pieces(batches):
            if m is None:
                zeros = np.zeros(b.num_rows)
                yield table(kind, b.column("doc_id"), zeros, zeros.astype(np.int32), [[]] * b.num_rows)
                continue
            buf, offsets = utf8(b.column("text"))
            doc, p, at, row = m.score(buf, offsets)
            ends = np.append(at[1:], len(buf))
            found: list[list[str]] = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(p >= offending):
                found[row[i]].append(buf[at[i] : ends[i]].tobytes().decode().strip())
            yield table(kind, b.column("doc_id"), doc, (doc >= threshold).astype(np.int32), found)

    return mapped(docs.select("doc_id", "text"), score, "doc_id long, score double, predicted int, offending array<string>")
