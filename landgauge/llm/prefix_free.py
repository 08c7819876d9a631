"""Repeated passages by prefix-free parsing and suffix order, over bytes.

A passage is removed where each of its ``window``-byte strings also starts earlier in the corpus.

* Parse: rolling hashes of short grams choose the triggers. The trigger of a window is its smallest gram, the
  first of equal ones, so equal windows hold their trigger at the same place and no window is without one. Neighbouring
  windows with the same trigger make one phrase: the stretch of text they cover. Phrases overlap by all but one byte of a
  window, and each window belongs to exactly one phrase.
* Dictionary: phrases are sorted by trigger and content (as hashes). All but the first occurrence of a phrase are repeats, whole.
  A phrase that shares its trigger with no other one has no more to tell; most of the corpus ends here.
* Suffix order: the first occurrences of phrases that share a trigger are fetched, and the suffixes of these
  dictionary entries are put in order to the depth of a window by prefix doubling. Equal neighbours are equal windows; all
  but the earliest in the corpus are repeats.

A batch deals out a phrase that it holds many times once, so copies make no hot key; the dictionary is read in sorted
order with a state of one row; triggers shared by more than ``crowd`` different phrases are settled window by window
in Spark instead of one task.

Null and empty texts have no bytes. A null id counts as larger than all others; texts of one id, or of none, follow each other by
a hash of the text, and every further row with the same id and text is a later document, a repeat from end to end. All are
searched. ``window`` is 1,000 at most. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.llm import bytesops as B
from landgauge.llm.common import mapped, pieces, stored, table, utf8

LAST = 9223372036854775807
GRAM = 24
BATCH = 2 << 20
U = np.uint64


def phrases(buf: np.ndarray, offsets: np.ndarray, window: int):
    """First window, number of windows, place of the trigger after the first window, trigger and content hash of all phrases."""
    empty = np.empty(0, np.int64)
    n = len(buf)
    if n < window:
        return empty, empty, empty, empty, empty
    gram = min(GRAM, window)
    sums = B.prefix_sums(buf)
    m = n - gram + 1
    grams = B.mix((sums[gram:] - sums[:-gram]) * B.powers(B.BACK, m))
    low = U((1 << max(24, n.bit_length())) - 1)
    best = (grams & ~low) | np.arange(m, dtype=U)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if span > width:
        best = np.minimum(best[: width - span], best[span - width :])
    trigger = (best & low).astype(np.int64)
    whole = np.ones(n, bool)
    whole[B.ranges(np.maximum(offsets[:-1], offsets[1:] - window + 1), np.minimum(np.diff(offsets), window - 1))] = False
    whole = whole[: n - window + 1]
    change = np.append(True, trigger[1:] != trigger[:-1])
    first = np.flatnonzero(whole & (change | np.append(True, ~whole[:-1])))
    last = np.flatnonzero(whole & (np.append(change[1:], True) | np.append(~whole[1:], True)))
    place = trigger[first] - first
    content = B.mix(B.range_hash(sums, first, last + window) + place.astype(U))
    return first, last - first + 1, place, grams[trigger[first]].view(np.int64), content.view(np.int64)


def pack(start: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Start in the document, number of windows and place of the trigger as one number that sorts by start."""
    return start << 20 | count << 10 | place


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 20, packed >> 10 & 1023, packed & 1023


def parse(docs: DataFrame, window: int) -> DataFrame:
    kind = [("part", pa.int64()), ("again", pa.bool_()), ("t", pa.int64()), ("c", pa.int64()), ("id", pa.int64()), ("at", pa.int64())]

    def work(batches):
        for b in pieces(batches, BATCH):
            buf, offsets = utf8(b.column("text"))
            first, count, place, trigger, content = phrases(buf, offsets, window)
            row = B.rows_of(first, offsets)
            ids = b.column("id").to_numpy()[row]
            at = pack(first - offsets[row], count, place)
            order = np.lexsort((at, ids, content))
            ids, at, trigger, content = ids[order], at[order], trigger[order], content[order]
            new = np.append(True, content[1:] != content[:-1])[: len(content)]
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            again = (ids > ids[head]) | (at > at[head])
            keep = new | again
            part = np.where(again, B.mix(at.view(U) + ids.view(U)).view(np.int64), trigger)
            yield table(kind, part[keep], again[keep], trigger[keep], content[keep], ids[keep], at[keep])

    return mapped(docs, work, "part long, again boolean, t long, c long, id long, at long")


def regrouped(batches, rows: int = 1 << 16):
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def settle(parsed: DataFrame) -> DataFrame:
    """(t, id, at, open): repeats of whole phrases; with ``open``, first occurrences that share a trigger with another phrase."""
    kind = [("t", pa.int64()), ("id", pa.int64()), ("at", pa.int64()), ("open", pa.bool_())]

    def work(batches):
        state, pending = None, False
        for b in regrouped(batches):
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("t", "c", "id", "at", "again")}
            local = cols.pop("again")
            if local.any():
                yield table(kind, cols["t"][local], cols["id"][local], cols["at"][local], np.zeros(int(local.sum()), bool))
                cols = {k: v[~local] for k, v in cols.items()}
            if not len(cols["t"]):
                continue
            carried = state is not None
            if carried:
                cols = {k: np.append(state[k], v) for k, v in cols.items()}
            t, c, ids, at = (cols[k] for k in ("t", "c", "id", "at"))
            new = np.append(True, (t[1:] != t[:-1]) | (c[1:] != c[:-1]))
            heads = np.flatnonzero(new)
            head = heads[np.cumsum(new) - 1]
            repeat = (ids > ids[head]) | (ids == ids[head]) & (at > at[head])
            shared = np.append(False, t[heads[1:]] == t[heads[:-1]])
            waiting = ~shared
            if carried:
                waiting[0] = pending
            told = shared | waiting & np.append(shared[1:], False)
            open_rows = heads[told]
            rows = np.concatenate([np.flatnonzero(repeat), open_rows])
            yield table(kind, t[rows], ids[rows], at[rows], np.arange(len(rows)) >= len(rows) - len(open_rows))
            state = {k: v[heads[-1] : heads[-1] + 1] for k, v in cols.items()}
            pending = bool(waiting[-1] and not told[-1])

    dealt = parsed.repartition("part").sortWithinPartitions("again", "t", "c", "id", "at")
    return mapped(dealt, work, "t long, id long, at long, open boolean")


def entries(docs: DataFrame, open_rows: DataFrame, window: int) -> DataFrame:
    """The bytes of dictionary entries: t, id, at, bytes."""
    kind = [("t", pa.int64()), ("id", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())]
    wanted = open_rows.groupBy("id").agg(F.collect_list("t").alias("ts"), F.collect_list("at").alias("ats"))

    def work(batches):
        for b in pieces(batches, BATCH):
            buf, offsets = utf8(b.column("text"))
            n = b.column("ats").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), n)
            at = b.column("ats").flatten().to_numpy()
            start, count, _ = unpack(at)
            size = count + window - 1
            data = buf[B.ranges(start + offsets[row], size)]
            ends = np.concatenate([[0], np.cumsum(size)])
            content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield table(kind, b.column("ts").flatten(), b.column("id").to_numpy()[row], at, content.cast(pa.binary()))

    return mapped(docs.join(wanted, "id"), work, "t long, id long, at long, bytes binary")


def dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ranked = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
    return out


def window_ranks(buf: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """The place of each window among all windows in suffix order; equal windows have the same."""
    n = len(buf)
    padded = np.append(buf, np.zeros(8, np.uint8)).astype(U)
    key = np.zeros(n, U)
    for k in range(8):
        key = (key << U(8)) | padded[k : k + n]
    rank, width = dense(key), 8
    if window < 8:
        return dense(key[starts] >> U(64 - 8 * window))
    while 2 * width <= window:
        later = np.zeros(n, np.int64)
        later[: n - width] = rank[width:] + 1
        rank = dense(rank * (n + 1) + later)
        width *= 2
    return dense(rank[starts] * (n + 1) + rank[starts + window - width])


def spans_of(again: np.ndarray, row: np.ndarray, ids: np.ndarray, start: np.ndarray, window: int):
    """Merged spans (id, first byte, end) of the windows that are repeats; row: the phrase of each window."""
    borders = np.searchsorted(row, np.arange(len(ids) + 1))
    a, z = B.runs(again, borders)
    r = row[a]
    return ids[r], start[r] + a - borders[r], start[r] + z - 1 - borders[r] + window


SPAN = [("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]


def compare(found: DataFrame, window: int) -> DataFrame:
    """Spans of windows that an earlier entry with the same trigger holds too."""

    def judged(rows: pa.Table):
        buf, offsets = binary(rows["bytes"].combine_chunks())
        ids, at = rows["id"].to_numpy(), rows["at"].to_numpy()
        start, count, _ = unpack(at)
        row = np.repeat(np.arange(len(ids)), count)
        local = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        rank = window_ranks(buf, offsets[row] + local, window)
        place = start[row] + local
        order = np.lexsort((place, ids[row], rank))
        new = np.append(True, rank[order][1:] != rank[order][:-1])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        again = np.empty(len(row), bool)
        again[order] = (ids[row[order]] > ids[row[head]]) | (place[order] > place[head])
        return table(SPAN, *spans_of(again, row, ids, start, window))

    def work(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.column("bytes").nbytes
            if size < BATCH:
                continue
            # All but the last trigger are complete.
            rows = pa.Table.from_batches(held)
            t = rows["t"].to_numpy()
            cut = int(np.searchsorted(t, t[-1]))
            if cut:
                yield judged(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(x.column("bytes").nbytes * x.num_rows // max(1, rows.num_rows) for x in held)
        if held:
            yield judged(pa.Table.from_batches(held))

    return mapped(found.repartition("t").sortWithinPartitions("t"), work, "id long, start long, end long")


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def compare_crowded(found: DataFrame, window: int) -> DataFrame:
    """The same, window by window: the earliest place of every window is an aggregate, so no task holds a trigger's entries."""
    kind = [("id", pa.int64()), ("hash", pa.int64()), ("start", pa.int64())]

    def work(batches):
        for b in batches:
            buf, offsets = binary(b.column("bytes"))
            start, count, _ = unpack(b.column("at").to_numpy())
            row = np.repeat(np.arange(b.num_rows), count)
            local = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = offsets[row] + local
            hashes = B.range_hash(B.prefix_sums(buf), at, at + window)
            yield table(kind, b.column("id").to_numpy()[row], hashes.view(np.int64), start[row] + local)

    windows = stored(mapped(found, work, "id long, hash long, start long"), "windows")
    earliest = windows.groupBy("hash").agg(F.min(F.struct("id", "start")).alias("head"))
    later = windows.join(earliest, "hash").where(F.struct("id", "start") > F.col("head"))
    return later.select("id", "start", (F.col("start") + window).alias("end"))


def repeated_spans(docs: DataFrame, window: int, crowd: int) -> DataFrame:
    """(id, start, end), not merged, of all repeats in ``docs`` (id, text)."""
    settled = stored(settle(parse(docs, window)), "settled")
    start, count = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023)
    whole = settled.where(~F.col("open")).select("id", start.alias("start"), (start + count + window - 1).alias("end"))
    found = stored(entries(docs, settled.where("open"), window), "entries")
    crowded = stored(found.groupBy("t").count().where(F.col("count") > crowd).select("t"), "crowded")
    if crowded.isEmpty():
        return whole.unionByName(compare(found, window))
    plain = compare(found.join(crowded, "t", "left_anti"), window)
    return whole.unionByName(plain).unionByName(compare_crowded(found.join(crowded, "t"), window))


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, id, text, copies): documents by ascending id, rows with the same id and text as one.

    Ids that are all different order themselves. Else all documents are numbered, by keys of fixed size.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("id"), "text")
    twice = stored(rows.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("id"), "repeated-ids")
    if twice.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long"))
    once = rows.join(twice, "id", "left_anti").withColumn("copies", F.lit(1).cast("long"))
    many = rows.join(twice, "id", "left_semi").groupBy("doc_id", "id", "text").agg(F.count("*").alias("copies"))
    key = ["id", "h", "other"]
    all_rows = once.unionByName(many).withColumns({"h": F.xxhash64("text"), "other": F.xxhash64(F.lit(1), "text")})
    all_rows = stored(all_rows, "documents")
    numbers = all_rows.select(*key).orderBy(*key).withColumn("number", F.monotonically_increasing_id())
    numbered = all_rows.join(stored(numbers, "numbers"), key).select("doc_id", F.col("number").alias("id"), "text", "copies")
    return stored(numbered, "documents")


def remove_repeats(docs: DataFrame, window: int = 100, crowd: int = 20_000) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, starts and ends of the removed spans, kept (binary)."""
    if not 1 <= window <= 1000:
        raise ValueError("window is 1 to 1,000 bytes")
    rows = in_order(docs)
    spans = repeated_spans(rows.select("id", "text").where(F.octet_length("text") >= window), window, crowd)
    per_doc = spans.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    kind = [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary()),
    ]

    def cut(batches):
        from landgauge.llm.common import lists

        for b in pieces(batches):
            buf, offsets = utf8(b.column("text"))
            n = b.column("starts").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            base = np.repeat(offsets[:-1], n)
            flat = lambda c: b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) + base
            gone = B.covered(flat("starts"), flat("ends"), len(buf))
            a, z = B.runs(gone, offsets)
            row = B.rows_of(a, offsets)
            per_row = np.bincount(row, minlength=b.num_rows)
            left = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), b.num_rows, [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(buf[~gone])]
            )
            size = np.diff(offsets)
            yield table(
                kind, b.column("doc_id"), size, size - np.diff(left), per_row,
                lists(a - offsets[row], per_row, pa.int64()), lists(z - offsets[row], per_row, pa.int64()), data.cast(pa.binary()),
            )

    # Further copies of a row are repeats as a whole, if a window fits into them.
    joined = rows.join(per_doc, "id", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    again = (F.col("copy") > 1) & (size >= window)
    marks = [
        F.when(again, F.array(F.lit(0).cast("long"))).otherwise(F.col("starts")).alias("starts"),
        F.when(again, F.array(size)).otherwise(F.col("ends")).alias("ends"),
    ]
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept binary"
    return mapped(joined.select("doc_id", "text", *marks), cut, out)
