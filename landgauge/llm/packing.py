"""Packing token pieces into sequences of fixed capacity, by bin completion.

* Documents become token ids, one end id each; longer ones are cut into pieces of the capacity. Texts are cut at blanks, which
  the tokenizer drops, and between ASCII letters, digits and signs, where it cuts as well (the apostrophe and the bar of its
  special strings aside), and each distinct chunk is encoded once. This holds for tokenizers with such rules.
* Only lengths matter for packing, so the problem is a count per length: at most as many numbers as the capacity,
  whatever the number of documents. Nothing else of the documents reaches the driver.
* Incumbent: best fit in decreasing order. Bin completion then branches on the fillings around the largest piece left.
  A filling is left out if a larger piece could take the place of some of its pieces (it is dominated). A branch is left
  if its waste exceeds what one sequence less would allow, or if a lower bound says so. A filling is applied as
  often as the counts allow first, then once; so a branch is as short as the list of lengths.
* The search ends when the incumbent meets the lower bound, when all is enumerated, or after ``nodes`` branches with
  ``width`` fillings each, found in ``steps`` steps. These bound its effort, not the rows; the best packing found is used.
* The solution is a short list of patterns with multiplicities. A piece's number among those of its length (counted per
  task, plus the tasks before) tells its pattern, sequence and place.

Null text is empty and packs as one end id. Repeated rows and rows without an id are pieces of their own. No documents give
no rows. Only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgauge.llm import bytesops as B
from landgauge.llm.common import mapped, pieces, stored, table, texts, utf8

#: Chunks a worker keeps, and the bytes of the longest one kept.
KEPT, KEPT_BYTES = 1_000_000, 64

#: Kinds of ASCII between which the tokenizer cuts: letters, digits (each on its own), signs; 0 is none of them.
_KIND = np.zeros(256, np.uint8)
_KIND[:128] = 3
_KIND[B.BLANK] = _KIND[[39, 124]] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2

Pattern = tuple[int, list[tuple[int, int]]]  # how often, and (length, times) in it


class ChunkEncoder:
    """Token ids of whole texts, from those of their blank-separated chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.at, self.n = np.zeros(1 << 14, np.int64), 0  # ends of the chunks' ids, from place 1 on
        self.asked = np.zeros(1 << 14, bool)  # chunks met again since they came

    def thin_out(self) -> None:
        """Keep the chunks that were met again."""
        old = np.flatnonzero(self.asked[: self.n])
        place = np.full(self.n, -1)
        place[old] = np.arange(len(old))
        self.known = {c: p for c, i in self.known.items() if (p := int(place[i])) >= 0}
        sizes = self.at[old + 1] - self.at[old]
        ids = self.ids[B.ranges(self.at[old], sizes)]
        self.ids[: len(ids)] = ids
        self.at[1 : len(old) + 1] = np.cumsum(sizes)
        self.n, self.used = len(old), len(ids)
        self.asked[:] = False

    def add(self, chunks: list[str]) -> np.ndarray:
        """Encode chunks and put them at the end of the table; their places in it."""
        found = [e.ids for e in self.model.encode_batch_fast(chunks, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        while self.used + int(sizes.sum()) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(found) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.asked = np.concatenate([self.asked, np.zeros_like(self.asked)])
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))
        self.ids[self.used : self.used + len(flat)] = flat
        self.at[self.n + 1 : self.n + 1 + len(found)] = self.used + np.cumsum(sizes)
        places = np.arange(self.n, self.n + len(found))
        self.used += len(flat)
        self.n += len(found)
        return places

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number per text."""
        flat, counts = [np.empty(0, np.uint32)], np.zeros(len(offsets) - 1, np.int64)
        for lo, hi in B.slabs(buf, offsets, B.BLANK, 1 << 20):
            part, borders = buf[lo:hi], np.clip(offsets - lo, 0, hi - lo)
            kind = _KIND[part]
            apart = (kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
            starts, ends = B.word_bounds(~B.BLANK[part], np.concatenate([borders, np.flatnonzero(apart) + 1]))
            if len(starts) == 0:
                continue
            if b"<|" not in part.tobytes():  # special strings are told by case
                # A letter before another character may form one with it, which has a case of its own.
                plain = np.append(part[1:] < 128, True)
                part = np.where(plain, B.LOWER[part], part)
            sizes = ends - starts
            chunks = texts(part[B.ranges(starts, sizes)], np.concatenate([[0], np.cumsum(sizes)])).dictionary_encode()
            if self.n > KEPT:
                self.thin_out()
                if self.n > KEPT // 2:
                    self.forget()
            names = chunks.dictionary.to_pylist()
            place = np.array([self.known.get(c, -1) for c in names], np.int64)
            new = np.flatnonzero(place < 0)
            self.asked[place[place >= 0]] = True
            base = self.n
            if len(new):
                # Long chunks go last, so that they can be dropped from the table's end.
                new = new[np.argsort([len(names[i]) > KEPT_BYTES for i in new], kind="stable")]
                place[new] = self.add([names[i] for i in new])
            which = place[chunks.indices.to_numpy()]
            first, size = self.at[which], self.at[which + 1] - self.at[which]
            flat.append(self.ids[B.ranges(first, size)])
            counts += np.bincount(B.rows_of(starts, borders), weights=size, minlength=len(counts)).astype(np.int64)
            if len(new):
                short = sum(len(names[i]) <= KEPT_BYTES for i in new)
                self.known.update((names[i], base + k) for k, i in enumerate(new[:short]))
                self.n, self.used = base + short, int(self.at[base + short])
        return np.concatenate(flat), counts


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One per worker process, so that chunks stay known from task to task."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and its number ``rank`` among those of its length in ``task``."""
    kind = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("rank", pa.int64()),
    ]

    def work(batches):
        tokens, task = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in pieces(batches, 2 << 20):
            flat, counts = tokens.encode(*utf8(b.column("text")))
            out = np.full(len(flat) + len(counts), end_id, "<u4")
            out[np.arange(len(flat)) + np.repeat(np.arange(len(counts)), counts)] = flat
            sizes = counts + 1
            parts = -(-sizes // capacity)
            number = B.ranges(np.zeros(len(parts), np.int64), parts)
            start = number * capacity
            row = np.repeat(np.arange(len(parts)), parts)
            length = np.minimum(capacity, sizes[row] - start)
            at = (np.cumsum(sizes) - sizes)[row] + start
            raw = memoryview(out).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(length, minlength=capacity + 1)
            yield table(kind, b.column("doc_id").take(pa.array(row)), number, start, length, crc, np.full(len(row), task), rank)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return mapped(docs.select("doc_id", "text"), work, schema)


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any packing needs: for each k, pieces above capacity - k stay alone, and what is from k to half
    the capacity fits beside the larger halves or not."""
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])  # number[s]: pieces shorter than s
    amount = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[capacity + 1] - number[capacity - k + 1]
    paired = number[capacity - k + 1] - number[half + 1]
    free = paired * capacity - (amount[capacity - k + 1] - amount[half + 1])
    rest = amount[half + 1] - amount[k]
    return int((alone + paired + np.maximum(0, -(-(rest - free) // capacity))).max())


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best fit in decreasing order, for all pieces of a length at once."""
    capacity = len(counts) - 1
    rooms: list[int] = []  # free rooms, sorted; groups of equal sequences by room
    groups: dict[int, list[Pattern]] = {}

    def add(room: int, pattern: Pattern) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append(pattern)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                times = capacity // length
                whole, part = divmod(left, times)
                for n, t in ((whole, times), (min(1, part), part)):
                    if n:
                        add(capacity - t * length, (n, [(length, t)]))
                break
            room = rooms[i]
            n, items = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[i]
            times = room // length
            whole, part = divmod(left, times)
            full = min(n, whole)
            if full:
                add(room - times * length, (full, [*items, (length, times)]))
                left -= full * times
                n -= full
            if n and 0 < left < times:
                add(room - left * length, (1, [*items, (length, left)]))
                left, n = 0, n - 1
            if n:
                add(room, (n, items))
    return [p for room in rooms for p in groups[room]]


def dominated(filling: list[tuple[int, int]], room: int, counts: np.ndarray, sizes: list[int]) -> bool:
    """Whether a piece that is left could take the place of some pieces of the filling (or of none) that are shorter together."""
    inside = dict(filling)
    total, sums = 0, 1
    for size, times in filling:
        total += size * times
        for _ in range(times):
            sums |= sums << size
    for size in sizes:
        if size > room:
            continue
        if counts[size] <= inside.get(size, 0):
            continue
        low = max(0, total + size - room)
        if low < size and (sums >> low) & ((1 << (size - low)) - 1):
            return True
        if low <= size and size not in inside and sums >> size & 1:
            return True
    return False


def fillings(counts: np.ndarray, room: int, waste: int, width: int, steps: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Undominated fillings of a room as (waste, [(length, times)]), least waste first; none wastes more than ``waste``."""
    sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    if not sizes:
        return [(room, [])] if room <= waste else []
    onward = np.cumsum((counts[sizes] * sizes)[::-1])[::-1].tolist()
    smaller = [-s for s in sizes]
    found: list[tuple[int, list[tuple[int, int]]]] = []
    left = steps

    def smallest_left(chosen: list[tuple[int, int]]) -> int:
        held = dict(chosen)
        return next((s for s in reversed(sizes) if counts[s] > held.get(s, 0)), room + 1)

    def go(at: int, room: int, chosen: list[tuple[int, int]]) -> None:
        nonlocal left
        left -= 1
        if room <= waste and smallest_left(chosen) > room:
            found.append((room, list(chosen)))
        for j in range(max(at, bisect_left(smaller, -room)), len(sizes)):
            if room - onward[j] > waste or left <= 0 or len(found) >= width:
                return
            size = sizes[j]
            for times in range(min(int(counts[size]), room // size), 0, -1):
                chosen.append((size, times))
                go(j + 1, room - size * times, chosen)
                chosen.pop()
                if found and found[-1][0] == 0 and len(found[-1][1]) == 1 and found[-1][1][0][1] == 1:
                    return  # one piece fills the room: it dominates all else
                if left <= 0 or len(found) >= width:
                    return

    go(0, room, [])
    good = [f for f in found if not dominated(f[1], room, counts, sizes)]
    return sorted(good, key=lambda f: (f[0], [-s for s, _ in f[1]]))


def bin_completion(counts: np.ndarray, nodes: int = 5_000, width: int = 24, steps: int = 2_000) -> list[Pattern]:
    """Patterns that hold all pieces; ``counts[s]`` is the number of pieces of length ``s``, up to the capacity."""
    counts = np.asarray(counts, np.int64).copy()
    capacity = len(counts) - 1
    best = best_fit(counts)
    fewest, bound = sum(n for n, _ in best), lower_bound(counts)
    amount = int((counts * np.arange(capacity + 1)).sum())

    def branches(used: int, wasted: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """(times, waste, pieces of a sequence) around the largest piece left."""
        if used + lower_bound(counts) >= fewest:
            return
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        options = fillings(counts, capacity - largest, (fewest - 1) * capacity - amount - wasted, width, steps)
        counts[largest] += 1
        for waste, chosen in options:
            items = dict(chosen)
            items[largest] = items.get(largest, 0) + 1
            most = min(int(counts[s]) // t for s, t in items.items())
            for times in {most: 0, 1: 0}:
                yield times, waste, sorted(items.items(), reverse=True)

    path: list[Pattern] = []
    open_branches = [branches(0, 0)] if fewest > bound else []
    spent = [(0, 0)]
    while open_branches and nodes and fewest > bound:
        used, wasted = spent[-1]
        step = next(open_branches[-1], None)
        if step is None:
            open_branches.pop()
            spent.pop()
            if path:
                times, items = path.pop()
                for s, t in items:
                    counts[s] += times * t
            continue
        times, waste, items = step
        if wasted + waste * times > (fewest - 1) * capacity - amount or used + times >= fewest:
            continue
        nodes -= 1
        for s, t in items:
            counts[s] -= times * t
        path.append((times, items))
        spent.append((used + times, wasted + waste * times))
        if counts.any():
            open_branches.append(branches(used + times, wasted + waste * times))
        else:
            fewest, best = used + times, list(path)
            open_branches.append(iter(()))
    return best


def slots(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Where pieces go: (length, first piece of it, times per sequence, first sequence, offset), sorted by the first two."""
    rows, taken, sequence = [], {}, 0
    for n, items in patterns:
        offset = 0
        for length, times in items:
            first = taken.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            taken[length] = first + n * times
            offset += length * times
        sequence += n
    return tuple(np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, nodes: int = 5_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = stored(token_pieces(docs, path, capacity, end_id), "pieces")
    dealt = stored(found.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in dealt.groupBy("length").agg(F.sum("n")).collect():  # one row per length at most
        counts[length] = n
    length, first, times, sequence, offset = slots(bin_completion(counts, nodes))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    placed = found.join(dealt.select("task", "length", before.alias("before")), ["task", "length"])
    #: Numbers of pieces of one length stay below 2^44, so length and number make one key.
    keys = (length << 44) + first
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    kind = [("doc_id", pa.int64()), ("piece", pa.int32()), *[(c, pa.int64()) for c in (*names[2:], "sequence_id", "offset")]]

    def work(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            size, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            slot = np.searchsorted(keys, (size << 44) + number, side="right") - 1
            number = number - first[slot]
            held = times[slot]
            yield table(kind, *[b.column(c) for c in names], sequence[slot] + number // held, offset[slot] + number % held * size)

    rows = placed.select(*names, (F.col("rank") + F.col("before")).alias("number"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return mapped(rows, work, schema, 20_000)
