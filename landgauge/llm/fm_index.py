"""Benchmark decontamination with one FM-index per training shard.

A shard is a batch of documents. Its words become one string of word numbers; words that no benchmark item has
become a separator, and stretches between separators that are shorter than the shortest window are left out, as no window
can lie there. The string's suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix.
All windows of all items are searched backwards at once by its ranks; occurrences are located by walking back to the
next sampled suffix. Covered words become spans, which are merged where they overlap.

Benchmark items come in blocks of bounded size (``BLOCK_BYTES`` of text on average); a task holds one block at a time, and
all blocks are searched in every shard, so the benchmark may be of any size.

Words are lower-cased runs of digits, letters and non-ASCII characters. A null or empty text, and one without words, has no
words: nothing is hit, and an item of that kind is never found. A null item id is named "null". Repeated rows are
judged one by one. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.llm import bytesops as B
from landgauge.llm.common import lists, mapped, pieces, table, texts, utf8

BLOCK_BYTES = 8 << 20
SAMPLE = 8

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True


def words(column: pa.Array):
    buf, offsets = utf8(column)
    lower = B.LOWER[buf]
    starts, ends = B.word_bounds(_WORD[lower], offsets)
    return B.range_hash(B.prefix_sums(lower), starts, ends, lower), starts, ends, B.rows_of(starts, offsets)


class Windows:
    """The distinct windows of a block of items, as word numbers (from 1), by length; and the items of each."""

    def __init__(self, items: list[str], column: pa.Array, width: int):
        hashes, _, _, row = words(column)
        self.items = items
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        n = np.bincount(row, minlength=len(items))
        first = np.cumsum(n) - n
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length in sorted({min(width, int(k)) for k in n if k}):
            own = np.flatnonzero(n >= width if length == width else n == length)
            places = np.concatenate([first[i] + np.arange(n[i] - length + 1) for i in own])
            owner = np.concatenate([np.full(n[i] - length + 1, i) for i in own])
            grid = numbers[places[:, None] + np.arange(length)]
            distinct, which = np.unique(grid, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), owner], 1), axis=0)
            self.groups.append((distinct, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]))
        self.shortest = min((g[0].shape[1] for g in self.groups), default=0)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of a shard's words, 0 for those of no item."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling, until all ranks differ."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    width = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - width] = rank[width:] + 1
        key = rank.astype(np.int64) * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
        if new[-1] == n - 1 or width >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2


class WaveletMatrix:
    """Ranks and symbols of a string of whole numbers, one bit level after the other."""

    def __init__(self, text: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.levels = []
        for level in range(self.bits - 1, -1, -1):
            bit = (text >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            self.levels.append((level, ones, len(text) - int(ones[-1])))
            text = np.concatenate([text[bit == 0], text[bit == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros(len(before), np.int64)
        for level, ones, zeros in self.levels:
            one = (symbol >> level) & 1 == 1
            before = np.where(one, zeros + ones[before], before - ones[before])
            start = np.where(one, zeros + ones[start], start - ones[start])
        return before - start

    def symbol(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(place), np.int64)
        for _, ones, zeros in self.levels:
            one = ones[place + 1] > ones[place]
            out = out * 2 + one
            place = np.where(one, zeros + ones[place], place - ones[place])
        return out


class FMIndex:
    def __init__(self, text: np.ndarray, largest: int):
        suffixes = suffix_array(text)
        self.n = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        self.matrix = WaveletMatrix(text[suffixes - 1], largest)
        sampled = suffixes % SAMPLE == 0
        self.sampled, self.samples = sampled, suffixes[sampled]
        self.sample_rank = np.cumsum(sampled) - 1

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-but-one row of each pattern's suffixes; equal where there is none."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low[alive] = self.before[symbol] + self.matrix.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.matrix.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
            if not len(alive):
                break
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the text of each row's suffix."""
        out, steps, todo = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            at = rows[todo]
            done = self.sampled[at]
            out[todo[done]] = self.samples[self.sample_rank[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            symbol = self.matrix.symbol(at)
            rows[todo] = self.before[symbol] + self.matrix.rank(symbol, at)
            steps += 1
        return out


def occurrences(numbers: np.ndarray, row: np.ndarray, windows: Windows):
    """(place, length, group, window) of every occurrence of every window."""
    offsets = np.searchsorted(row, np.arange(int(row[-1]) + 2)) if len(row) else np.zeros(1, np.int64)
    starts, ends = B.word_bounds(numbers > 0, offsets)
    long_enough = ends - starts >= windows.shortest
    starts, sizes = starts[long_enough], (ends - starts)[long_enough]
    if not len(starts):
        return
    # Stretches with a separator behind each.
    places = B.ranges(starts, sizes + 1)
    last = np.cumsum(sizes + 1) - 1
    text = numbers[np.minimum(places, len(numbers) - 1)] + 1
    text[last] = 1
    # One end mark, below all else: walking back is only right if the last suffix differs from all separators.
    index = FMIndex(np.append(text, 0), len(windows.vocabulary) + 1)
    for group, (patterns, _, _) in enumerate(windows.groups):
        low, high = index.search(patterns + 1)
        hits = np.flatnonzero(high > low)
        if len(hits):
            count = (high - low)[hits]
            at = index.locate(B.ranges(low[hits], count))
            yield places[at], patterns.shape[1], group, np.repeat(hits, count)


def blocks_of(benchmark: DataFrame, width: int) -> list:
    """The windows of the benchmark, broadcast block by block; only one block at a time is on the driver."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // BLOCK_BYTES
    out = []
    for k in range(n):
        got = rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toArrow()
        if got.num_rows:
            text = got["text"].combine_chunks() if got["text"].num_chunks else pa.array([], pa.string())
            out.append(spark.sparkContext.broadcast(Windows(got["item"].to_pylist(), text, width)))
    return out


def search(b: pa.RecordBatch, blocks: list):
    """Of each row of a batch: words, words hit, merged spans (flat, and how many), names of the items found."""
    hashes, starts, ends, row = words(b.column("text"))
    _, offsets = utf8(b.column("text"))
    n = b.num_rows
    hit = np.zeros(len(hashes), bool)
    items: list[set[str]] = [set() for _ in range(n)]
    for block in blocks:
        w = block.value
        if not w.groups:
            continue
        for place, length, group, which in occurrences(w.numbers(hashes), row, w):
            hit |= B.covered(place, place + length, len(hit))
            patterns, first, owner = w.groups[group]
            pairs = np.unique(row[place].astype(np.int64) * len(patterns) + which)
            for r, k in zip(*np.divmod(pairs, len(patterns))):
                items[r].update(w.items[i] for i in owner[first[k] : first[k + 1]])
    by_row = np.searchsorted(row, np.arange(n + 1))
    a, z = B.runs(hit, by_row)
    spans = np.bincount(row[a], minlength=n)
    return np.diff(by_row), np.bincount(row[hit], minlength=n), starts[a], ends[z - 1], spans, offsets, [sorted(s) for s in items]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words in windows), starts and ends of the merged spans in bytes, items."""
    blocks = blocks_of(benchmark, width)
    kind = [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
    ]

    def work(batches):
        for b in pieces(batches, 4 << 20):
            n_words, n_hit, starts, ends, spans, offsets, items = search(b, blocks)
            base = np.repeat(offsets[:-1], spans)
            places = (lists((x - base).astype(np.int32), spans, pa.int32()) for x in (starts, ends))
            yield table(kind, b.column("doc_id"), n_words, n_hit, *places, items)

    schema = "doc_id long, n_words long, n_hit long, starts array<int>, ends array<int>, items array<string>"
    return mapped(docs.select("doc_id", "text"), work, schema)


def without_spans(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` with the spans of benchmark windows cut out of the texts; all other columns stay."""
    blocks = blocks_of(benchmark, width)
    schema = docs.schema

    def cut(batches):
        for b in pieces(batches, 4 << 20):
            _, _, starts, ends, _, offsets, _ = search(b, blocks)
            buf, _ = utf8(b.column("text"))
            keep = ~B.covered(starts, ends, len(buf))
            left = np.concatenate([[0], np.cumsum(keep)])[offsets]
            text = texts(buf[keep], left)
            columns = [text if f.name == "text" else b.column(f.name) for f in schema.fields]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return mapped(docs, cut, schema)
