"""Product codes of vectors in whole numbers, trained with adaptive distance bounds.

* Components become floor(4096 x). A vector is cut into equal parts; every part position has a codebook of its own,
  which starts as that part of the vectors of smallest id and is moved to the floored means of its parts round by round.
* Each part keeps, from round to round, its nearest entry with an upper bound on the distance, the ``b`` next entries with
  ordered lower bounds, and one lower bound for all others. When entries move, bounds are loosened by how far. A part whose upper
  bound stays below all lower ones keeps its entry. Else its distance is taken anew, in whole numbers; then those of the
  ``b`` entries, if the outer bound still rules out the rest; then all. Distances are compared in whole numbers, equal ones by
  index, and roots are rounded to the safe side, so the result is that of comparing all.
* ``b`` adapts: it shrinks to what nearly all uncertain parts inside the outer bound needed, never below an eighth of the entries.
  What falls off joins the outer bound.

Bounds and vectors are written after every round and the round before is deleted. Sums and counts of the entries go the same
way, one row per task, and are added up in Spark; the driver gets the sums of 16 entries a part.

Vectors that are null or hold null or non-finite components are left out. Shorter vectors are filled with zeros to the longest,
and all to a multiple of the parts. Components beyond about 16,000 (at 64 dimensions; see ``reach``) count as that, so that
distances stay exact in 64 bits. Repeated ids are rows of their own; among equal ids the smaller vector seeds first, null
ids come last. Fewer rows than entries give fewer entries; no rows give no rows. A ``label_error`` beyond a long is null. Only
``vec_id``, ``embedding`` and ``label`` are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.llm.common import discard, lists, mapped, stored, table

SCALE = 4096
#: A bound no distance reaches.
FAR = np.int64((1 << 31) - 1)
STATE = [
    ("vec_id", pa.int64()), ("label", pa.int32()), ("q", pa.list_(pa.int32())), ("own", pa.list_(pa.int8())),
    ("upper", pa.list_(pa.int32())), ("near", pa.list_(pa.int8())), ("lower", pa.list_(pa.int32())),
    ("outer", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64())),
]
STATE_SCHEMA = (
    "vec_id long, label int, q array<int>, own array<byte>, upper array<int>, near array<byte>, lower array<int>, "
    "outer array<int>, sums array<long>"
)


def reach(width: int) -> int:
    """The largest whole component: squared distances of whole vectors stay below 2^60."""
    return 1 << ((58 - max(1, width - 1).bit_length()) // 2)


def whole_numbers(vectors: pa.ListArray, width: int) -> np.ndarray:
    """floor(4096 x) as (rows, width); short vectors end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = float(reach(width))
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.clip(np.floor(flat * SCALE), -limit, limit)
    return out


def floor_root(squares: np.ndarray) -> np.ndarray:
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def ceil_root(squares: np.ndarray) -> np.ndarray:
    root = floor_root(squares)
    return root + (root * root < squares)


class Bounds:
    """Assignments and bounds of a block of parts; ``entries`` is (parts, k, d), ``x`` is (rows, parts, d)."""

    def __init__(self, x: np.ndarray, entries: np.ndarray):
        self.parts, self.k, d = entries.shape
        self.x, self.entries = x.reshape(-1, d), entries.reshape(-1, d)
        self.base = np.tile(np.arange(self.parts) * self.k, len(x))  # of each part's codebook
        self.needs = np.zeros(self.k + 1, np.int64)  # uncertain parts by the bounds they needed

    def squared(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        diff = self.x[rows][:, None, :] - self.entries[self.base[rows][:, None] + ids]
        return np.einsum("rmd,rmd->rm", diff, diff)

    def compare_all(self, rows: np.ndarray) -> None:
        for start in range(0, len(rows), 8192):
            some = rows[start : start + 8192]
            square = self.squared(some, np.broadcast_to(np.arange(self.k), (len(some), self.k)))
            order = np.argsort(square, axis=1, kind="stable")
            square = np.take_along_axis(square, order, axis=1)
            b = self.near.shape[1]
            self.own[some], self.upper[some] = order[:, 0], ceil_root(square[:, 0])
            self.near[some], self.lower[some] = order[:, 1 : b + 1], floor_root(square[:, 1 : b + 1])
            self.outer[some] = floor_root(square[:, b + 1]) if b + 1 < self.k else FAR

    def fresh(self, b: int) -> None:
        n = len(self.x)
        self.own, self.upper, self.outer = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.near, self.lower = np.zeros((n, b), np.int64), np.zeros((n, b), np.int64)
        self.compare_all(np.arange(n))

    def kept(self, own, upper, near, lower, outer, b: int, moved: np.ndarray) -> None:
        """Go on from the bounds of the round before; ``moved`` is (parts, k), rounded up."""
        own, upper, outer = own.astype(np.int64), upper.astype(np.int64), outer.astype(np.int64)
        near, lower = near.reshape(len(own), -1).astype(np.int64), lower.reshape(len(own), -1).astype(np.int64)
        far = np.repeat(moved.max(axis=1)[None, :], len(own) // self.parts, axis=0).ravel()
        step = moved.ravel()
        self.own, self.upper = own, upper + step[self.base + own]
        lower = np.maximum(lower - step[self.base[:, None] + near], 0)
        self.outer = np.where(outer >= FAR, FAR, np.maximum(outer - far, 0))
        if near.shape[1] > b:
            self.outer = np.minimum(self.outer, lower[:, b:].min(axis=1))
        self.near, self.lower = near[:, :b], lower[:, :b]

    def settle(self) -> None:
        """Compare what the bounds leave open."""
        floor = np.minimum(self.lower.min(axis=1, initial=FAR), self.outer)
        rows = np.flatnonzero(self.upper >= floor)
        self.upper[rows] = ceil_root(self.squared(rows, self.own[rows][:, None])[:, 0])
        rows = rows[self.upper[rows] >= floor[rows]]
        out = self.upper[rows] >= self.outer[rows]
        b = self.near.shape[1]
        inside, outside = rows[~out], rows[out]
        reached = self.lower[inside] <= self.upper[inside][:, None]
        self.needs += np.bincount(b - np.argmax(reached[:, ::-1], axis=1), minlength=self.k + 1) if len(inside) else 0
        self.needs[min(b + 1, self.k)] += len(outside)
        self.compare_all(outside)
        if len(inside) == 0:
            return
        ids = np.sort(np.concatenate([self.own[inside][:, None], self.near[inside]], axis=1), axis=1)
        square = self.squared(inside, ids)
        order = np.argsort(square, axis=1, kind="stable")
        ids, square = np.take_along_axis(ids, order, axis=1), np.take_along_axis(square, order, axis=1)
        self.own[inside], self.upper[inside] = ids[:, 0], ceil_root(square[:, 0])
        self.near[inside], self.lower[inside] = ids[:, 1:], floor_root(square[:, 1:])

    def sums(self) -> np.ndarray:
        """Counts of all entries, then their component sums, then the needs."""
        n = self.parts * self.k
        which = self.base + self.own
        total = np.zeros((n, self.x.shape[1]), np.int64)
        order = np.argsort(which, kind="stable")
        ranked = which[order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, np.int64)
        if len(heads):
            total[ranked[heads]] = np.add.reduceat(self.x[order], heads, axis=0)
        return np.concatenate([np.bincount(which, minlength=n), total.ravel(), self.needs])


def per_row(flat: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    return lists(flat.ravel(), np.full(rows, flat.size // max(1, rows)), kind)


def resumed(b: pa.RecordBatch, entries: np.ndarray, bound: int, moved: np.ndarray) -> Bounds:
    def column(name: str) -> np.ndarray:
        return b.column(name).flatten().to_numpy(zero_copy_only=False)

    block = Bounds(column("q").astype(np.int64).reshape(b.num_rows, entries.shape[0], -1), entries)
    block.kept(*[column(c) for c in ("own", "upper", "near", "lower", "outer")], bound, moved)
    block.settle()
    return block


def first_round(vectors: DataFrame, entries: np.ndarray, bound: int) -> DataFrame:
    parts, _, d = entries.shape

    def work(batches):
        sums = 0
        for b in batches:
            if b.num_rows:
                x = whole_numbers(b.column("embedding"), parts * d)
                block = Bounds(x.reshape(b.num_rows, parts, d), entries)
                block.fresh(bound)
                sums = sums + block.sums()
                yield state(b.column("vec_id"), b.column("label"), x, block)
        yield from closing(sums)

    return mapped(vectors, work, STATE_SCHEMA, 2_000)


def state(ids: pa.Array, labels: pa.Array, x: np.ndarray, block: Bounds) -> pa.RecordBatch:
    n, i8, i32 = len(ids), pa.int8(), pa.int32()
    bounds = [
        per_row(block.own, n, i8), per_row(block.upper, n, i32), per_row(block.near, n, i8), per_row(block.lower, n, i32),
        per_row(block.outer, n, i32),
    ]
    return table(STATE, ids, labels.cast(pa.int32()), per_row(x, n, i32), *bounds, pa.nulls(n, pa.list_(pa.int64())))


def closing(sums):
    """The row that carries a task's sums."""
    if not isinstance(sums, int):
        yield table(STATE, *[pa.nulls(1, kind) for _, kind in STATE[:-1]], pa.array([sums.tolist()], pa.list_(pa.int64())))


def next_round(before: DataFrame, entries: np.ndarray, bound: int, moved: np.ndarray) -> DataFrame:
    def work(batches):
        sums = 0
        for b in batches:
            if b.num_rows:
                block = resumed(b, entries, bound, moved)
                sums = sums + block.sums()
                yield state(b.column("vec_id"), b.column("label"), block.x, block)
        yield from closing(sums)

    return mapped(before.where("sums IS NULL"), work, STATE_SCHEMA, 2_000)


def last_round(before: DataFrame, entries: np.ndarray, bound: int, moved: np.ndarray) -> DataFrame:
    kind = [("vec_id", pa.int64()), ("label", pa.int32()), ("code", pa.string()), ("error", pa.int64())]

    def work(batches):
        for b in batches:
            if b.num_rows:
                block = resumed(b, entries, bound, moved)
                rows = np.arange(len(block.x))
                error = block.squared(rows, block.own[:, None]).reshape(b.num_rows, -1).sum(axis=1)
                codes = [bytes(c).hex() for c in block.own.astype(np.uint8).reshape(b.num_rows, -1)]
                yield table(kind, b.column("vec_id"), b.column("label"), codes, error)

    return mapped(before.where("sums IS NULL"), work, "vec_id long, label int, code string, error long", 2_000)


def renewed(kept: DataFrame, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New entries, how far each moved (rounded up), and the needs, from the sums that tasks left."""
    parts, k, d = entries.shape
    cells = kept.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "v"))
    cells = cells.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    totals = [0] * (parts * k * (d + 1) + k + 1)
    for at, v in cells.collect():  # as many rows as the codebooks have numbers
        totals[at] = int(v)
    counts, sums, needs = totals[: parts * k], totals[parts * k : parts * k * (d + 1)], totals[parts * k * (d + 1) :]
    new, moved = entries.copy().reshape(-1, d), np.zeros(parts * k, np.int64)
    for e, n in enumerate(counts):
        if n:
            new[e] = [s // n for s in sums[e * d : (e + 1) * d]]
            square = sum((int(x) - int(y)) ** 2 for x, y in zip(new[e], entries.reshape(-1, d)[e]))
            root = isqrt(square)
            moved[e] = root + (root * root < square)
    return new.reshape(entries.shape), moved.reshape(parts, k), np.array(needs)


def adapted(bound: int, needs: np.ndarray, least: int) -> int:
    """The fewest bounds that were enough for all but a fiftieth of the uncertain parts that the outer bound left inside;
    never more than before, and as before where there were none."""
    inside = needs[: bound + 1]
    if inside.sum() == 0:
        return bound
    enough = np.cumsum(inside) >= inside.sum() * 0.98
    return int(min(bound, max(least, np.argmax(enough))))


def vector_codes(vectors: DataFrame, parts: int = 8, k: int = 16, rounds: int = 6) -> DataFrame:
    """Per kept row: vec_id, label, code, error, label_error, codebooks_sha256. At most 127 entries a part."""
    spark = vectors.sparkSession
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.select("vec_id", "embedding", F.col("label").cast("int").alias("label")).where(fine)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return spark.createDataFrame(
            [], "vec_id long, label int, code string, error long, label_error long, codebooks_sha256 string"
        )
    d = max(1, -(-longest // parts))
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(k).collect()
    first = whole_numbers(pa.array([list(s[0]) for s in seeds], pa.list_(pa.float64())), parts * d)
    entries = np.ascontiguousarray(first.reshape(len(seeds), parts, d).transpose(1, 0, 2))
    others = len(seeds) - 1
    least, bound = min(others, max(1, k // 8)), min(others, k // 2)
    held = None
    for _ in range(rounds):
        new = first_round(kept, entries, bound) if held is None else next_round(held, entries, bound, moved)
        new = stored(new, "bounds")
        if held is not None:
            discard(held)
        held = new
        entries, moved, needs = renewed(held, entries)
        bound = adapted(bound, needs, least)
    codes = stored(last_round(held, entries, bound, moved), "vector-codes")
    discard(held)
    digest = hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()
    errors = codes.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    joined = codes.join(errors, F.col("label").eqNullSafe(F.col("of")))
    label_error = F.col("total").try_cast("long").alias("label_error")
    return joined.select("vec_id", "label", "code", "error", label_error, F.lit(digest).alias("codebooks_sha256"))
