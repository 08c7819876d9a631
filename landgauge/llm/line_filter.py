"""Lines that many documents share, dropped by probing sharded minimal perfect hashes.

* Every document gives each key once (a line with blanks stripped at both ends and A-Z lower-cased). Keys are
  64-bit hashes; each Arrow batch sums its keys before the shuffle, so a line of very many documents is no hot row.
* The hashes of keys in at least ``min_docs`` documents go to shards by their low bits. Each shard builds a minimal
  perfect hash (levels of bit arrays; a key takes the first level where it is alone) over compact
  arrays: the full hash as fingerprint, the count, and the largest document that holds the line.
* Documents send their keys to the shards as arrays, one row per batch and shard; the shard's task probes its arrays
  and answers with the lines to drop. Shards are copied by the number of probes they get, of unique lines too, and the
  probes spread over the copies.

A null or empty text is one empty line. Repeated rows of an id are one document when counted. A null id counts as the
smallest. Keys of fewer than ``min_chars`` code points always stay. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.llm import bytesops as B
from landgauge.llm.common import lists, mapped, pieces, stored, table, texts, utf8

FIRST = -9223372036854775808
#: Distinct hashes in a shard at most (on average), and probes that one copy of a shard answers.
SHARD_KEYS = 100_000
COPY_PROBES = 100_000
#: Probes of one row at most; hashes of at least so many lines are counted to their own shard, all others to any alike.
ROW_PROBES = 10_000


def line_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines of all texts (without the line feed), and the text of each."""
    feeds = np.flatnonzero(buf == 10)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    ends = np.concatenate([offsets[1:], feeds])
    row = np.concatenate([np.arange(len(offsets) - 1), B.rows_of(feeds, offsets)])
    # By text, then by place; a text's own start sorts before the lines that follow a feed.
    starts_order = np.lexsort((starts, row))
    ends_order = np.lexsort((ends, row))
    return starts[starts_order], ends[ends_order], row[starts_order]


def keyed_lines(buf, offsets, min_chars):
    """Lines with the hash of their key, and whether the key is long enough to be dropped."""
    starts, ends, row = line_bounds(buf, offsets)
    solid = np.flatnonzero(~B.BLANK[buf])
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends)
    some = last > first
    a, b = starts.copy(), starts.copy()
    a[some] = solid[first[some]]
    b[some] = solid[last[some] - 1] + 1
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    low = B.LOWER[buf]
    hashes = B.range_hash(B.prefix_sums(low), a, b, low)
    return starts, ends, row, hashes, chars[b] - chars[a] >= min_chars


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(FIRST).to_numpy(zero_copy_only=False)


def distinct_pairs(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, sorted, and how often each stands."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1])
    return hashes[new], ids[new], np.diff(np.append(np.flatnonzero(new), len(new)))


def line_counts(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, int]:
    """Hashes of the keys in at least ``min_docs`` documents or very many lines: h, n, last, lines; and all lines long enough."""
    kind = [("h", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("lines", pa.int64())]

    def work(batches, again):
        for b in pieces(batches, 2 << 20):
            buf, offsets = utf8(b.column("text"))
            _, _, row, hashes, long_enough = keyed_lines(buf, offsets, min_chars)
            h, ids, lines = distinct_pairs(hashes[long_enough], ids_of(b.column("doc_id"))[row[long_enough]])
            if again:
                yield table(kind, h.view(np.int64), ids, np.ones(len(h), np.int64), ids, lines)
                continue
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
            n = np.diff(np.append(starts, len(h)))
            last = ids[np.append(starts[1:], len(h)) - 1] if len(h) else ids
            yield table(kind, h[starts].view(np.int64), last, n, last, np.add.reduceat(lines, starts) if len(h) else lines)

    schema = "h long, id long, n long, last long, lines long"
    docs = docs.select(F.coalesce("doc_id", F.lit(FIRST)).alias("doc_id"), "text")
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1).select("doc_id")
    repeated = stored(ids, "repeated-ids")
    if repeated.isEmpty():
        rows = mapped(docs, lambda batches: work(batches, False), schema)
    else:
        # An id of several rows counts once for a line: pairs of line and id meet, never texts.
        rows = mapped(docs.join(repeated, "doc_id", "left_anti"), lambda batches: work(batches, False), schema)
        many = mapped(docs.join(repeated, "doc_id", "left_semi"), lambda batches: work(batches, True), schema)
        many = many.groupBy("h", "id").agg(F.max("n").alias("n"), F.max("last").alias("last"), F.sum("lines").alias("lines"))
        rows = rows.unionByName(many)
    counts = rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("lines").alias("lines"))
    seen = Observation()
    counts = counts.observe(seen, F.sum("lines").alias("lines"))
    counts = stored(counts.where((F.col("n") >= min_docs) | (F.col("lines") >= ROW_PROBES)), "line-counts")
    return counts, seen.get["lines"] or 0


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys, with arrays in its order."""

    def __init__(self, levels: list[np.ndarray], ranks: list[np.ndarray], fingerprints, counts, last):
        self.levels, self.ranks = levels, ranks
        self.fingerprints, self.counts, self.last = fingerprints, counts, last

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (B.mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, last: np.ndarray) -> PerfectHash:
        levels, ranks, order, base = [], [], [], 0
        left = np.arange(len(keys))
        while len(left):
            size = max(64, 2 * len(left))
            at = cls.place(keys[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            ranks.append(base + np.cumsum(alone) - 1)
            mine = alone[at]
            base += int(mine.sum())
            order.append(left[mine][np.argsort(at[mine])])
            left = left[~mine]
        by = np.concatenate(order) if order else np.empty(0, np.int64)
        return cls(levels, ranks, keys[by], counts[by], last[by])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the arrays, or -1; a fingerprint tells keys that are not in it."""
        found = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self.place(keys[todo], level, len(bits))
            hit = bits[at]
            found[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        known = found >= 0
        found[known] = np.where(self.fingerprints[found[known]] == keys[known], found[known], -1)
        return found

    def pack(self) -> dict:
        return {
            "sizes": [len(x) for x in self.levels],
            "bits": b"".join(np.packbits(x).tobytes() for x in self.levels),
            "fingerprints": self.fingerprints.tobytes(),
            "counts": self.counts.astype(np.int64).tobytes(),
            "last": self.last.astype(np.int64).tobytes(),
        }

    @classmethod
    def unpack(cls, row: dict) -> PerfectHash:
        levels, ranks, at, base = [], [], 0, 0
        packed = np.frombuffer(row["bits"], np.uint8)
        for size in row["sizes"]:
            bits = np.unpackbits(packed[at : at + (size + 7) // 8])[:size].astype(bool)
            at += (size + 7) // 8
            levels.append(bits)
            ranks.append(base + np.cumsum(bits) - 1)
            base += int(bits.sum())
        arrays = (np.frombuffer(row[k], t) for k, t in (("fingerprints", np.uint64), ("counts", np.int64), ("last", np.int64)))
        return cls(levels, ranks, *arrays)


INDEX = "shard int, copies int, sizes array<long>, bits binary, fingerprints binary, counts binary, last binary"


def build_shards(counts: DataFrame, shards: int, others: int, min_docs: int) -> DataFrame:
    """One row per shard: its perfect hash and arrays, and over how many copies its probes spread.

    ``others``: the lines of each shard besides those in ``counts``.
    """

    def build(group: pa.Table) -> pa.Table:
        probes = int(group["lines"].to_numpy().sum()) + others
        common = np.flatnonzero(group["n"].to_numpy() >= min_docs)
        keys, n, last = (group[c].to_numpy()[common] for c in ("h", "n", "last"))
        packed = PerfectHash.build(keys.view(np.uint64), n, last).pack()
        row = {"shard": group["shard"][0].as_py(), "copies": 1 + probes // COPY_PROBES} | packed
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.table([pa.array([v][: len(common)], k) for v, k in zip(row.values(), kinds)], names=list(row))

    sharded = counts.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return stored(sharded.groupBy("shard").applyInArrow(build, INDEX), "line-index")


def lines_to_drop(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Per document with such lines: doc_id, mark (hash of its text), lines (places of the lines to drop)."""
    counts, probes = line_counts(docs, min_chars, min_docs)
    keys, held = counts.agg(F.count_if(F.col("n") >= min_docs), F.coalesce(F.sum("lines"), F.lit(0))).first()
    shards = 1 + keys // SHARD_KEYS
    index = build_shards(counts, shards, -(-(probes - held) // shards), min_docs)
    kind = [("shard", pa.int32()), ("salt", pa.int64()), ("hashes", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("lines", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))]

    def ask(batches):
        for b in pieces(batches, 2 << 20):
            buf, offsets = utf8(b.column("text"))
            starts, _, row, hashes, long_enough = keyed_lines(buf, offsets, min_chars)
            ids = ids_of(b.column("doc_id"))
            if not long_enough.any():
                continue
            line = np.arange(len(row)) - np.searchsorted(row, row)
            asked = np.flatnonzero(long_enough)
            shard = hashes[asked].view(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            asked, shard = asked[order], shard[order]
            place = np.arange(len(shard)) - np.searchsorted(shard, shard)
            at = np.flatnonzero(place % ROW_PROBES == 0)
            sizes = np.diff(np.append(at, len(shard)))
            mark = b.column("mark").to_numpy()[row[asked]]
            owner = (ids[row[asked]] ^ mark)[at].view(np.uint64)
            salt = (B.mix(owner * np.uint64(B.STEP) + line[asked][at].astype(np.uint64)) >> np.uint64(1)).view(np.int64)
            columns = (hashes[asked].view(np.int64), ids[row[asked]], line[asked], mark)
            yield table(kind, shard[at], salt, *(lists(c, sizes, pa.int64()) for c in columns))

    def answer(key, probes: pa.Table, shard: pa.Table) -> pa.Table:
        if not (probes.num_rows and shard.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in ("doc_id", "mark", "line")})
        own = PerfectHash.unpack(shard.slice(0, 1).to_pylist()[0])
        flat = {c: probes[c].combine_chunks().flatten().to_numpy() for c in ("hashes", "ids", "lines", "marks")}
        place = own.find(flat["hashes"].view(np.uint64))
        drop = place >= 0
        drop[drop] = (own.counts[place[drop]] >= min_docs) & (own.last[place[drop]] != flat["ids"][drop])
        return pa.table({"doc_id": flat["ids"][drop], "mark": flat["marks"][drop], "line": flat["lines"][drop]})

    asked = mapped(
        docs.select("doc_id", "text", F.xxhash64("text").alias("mark")),
        ask,
        "shard int, salt long, hashes array<long>, ids array<long>, lines array<long>, marks array<long>",
    )
    spread = index.select(F.col("shard").alias("owner"), F.col("copies").alias("over"))
    asked = asked.join(spread, F.col("shard") == F.col("owner"))
    asked = asked.select("shard", F.pmod("salt", "over").cast("int").alias("copy"), "hashes", "ids", "lines", "marks")
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    copied = copied.select([F.col(c).alias(c) for c in copied.columns])
    hits = asked.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInArrow(answer, "doc_id long, mark long, line long")
    return stored(hits.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("lines")), "line-hits")


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, names=("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the text that stays (lines joined by a line feed), and under ``names`` the numbers of lines before
    and dropped (their own columns of these names go)."""
    hits = lines_to_drop(docs, min_chars, min_docs)
    docs = docs.drop(*names)
    added = [T.StructField(n, T.LongType()) for n in names]
    own = docs.schema.names
    schema = T.StructType([*docs.schema.fields, *added])

    def cut(batches):
        for b in pieces(batches, 2 << 20):
            buf, offsets = utf8(b.column("text"))
            starts, ends, row = line_bounds(buf, offsets)
            rows = b.num_rows
            first = np.searchsorted(row, np.arange(rows))
            n_lines = np.bincount(row, minlength=rows)
            dropped = np.zeros(len(row), bool)
            marks = b.column("__lines")
            counts = marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            dropped[np.repeat(first, counts) + marks.flatten().to_numpy().astype(np.int64)] = True
            keep = np.flatnonzero(~dropped)
            # A kept line takes its bytes and, but for the last one kept of its text, a line feed.
            size = ends[keep] - starts[keep]
            feed = np.append(row[keep][1:] == row[keep][:-1], False)[: len(keep)]
            out = np.empty(int((size + feed).sum()), np.uint8)
            at = np.cumsum(size + feed) - (size + feed)
            out[B.ranges(at, size)] = buf[B.ranges(starts[keep], size)]
            out[(at + size)[feed]] = 10
            total = np.bincount(row[keep], weights=size + feed, minlength=rows).astype(np.int64)
            kept = texts(out, np.concatenate([[0], np.cumsum(total)]))
            columns = [kept if c == "text" else b.column(c) for c in own]
            columns += [pa.array(n_lines), pa.array(np.bincount(row[dropped], minlength=rows))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    keyed = docs.withColumn("__id", F.coalesce("doc_id", F.lit(FIRST))).withColumn("__mark", F.xxhash64("text"))
    hits = hits.toDF("__id", "__mark", "__lines")
    return mapped(keyed.join(hits, ["__id", "__mark"], "left").select(*docs.columns, "__lines"), cut, schema)
