"""Spelling variants: words one character apart, found by permuterm rotations.

* Words are counted over all texts: maximal runs of letters, A-Z lower-cased. Every 31st run, by a checksum of document
  and run, loses one character, so that variants exist.
* The rotations of a word marked with a terminator are its permuterm entries. Rotated so that an edited character comes
  last, a word is the prefix before that character, and all words with this prefix differ there only: they are
  replacements of each other. A word whose whole rotation is the prefix lacks the character: it is a deletion.
* Rotations are sorted by prefix and scanned group by group. A group holds a word per character of the alphabet and
  one without it, never more. Pairs are not written out: each word gets the number of its neighbours in the group and the
  first of them by count and code-point order, both from the places of the group's first members. Two words meet as
  replacements in one group; of a run of equal characters only the first is skipped for deletions, so
  they meet once as well.
* A word's form is its neighbour of largest count, if that is ten times its own. Forms are followed to the last by
  doubling; counts grow tenfold at every step, so a few rounds end it.

Words are numbered in code-point order, and rows carry numbers. Prefixes of more than 64 characters are replaced by
fingerprints of 127 bits, so a word of a million letters costs two short rows per letter.

Null texts have no words; a null id is empty text in the checksum; rows that repeat count each. No words give no rows.
Only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.llm import bytesops as B
from landgauge.llm.common import mapped, pieces, stored, table, texts, utf8

#: Marks the end of a word; no word holds it.
END = "\0"
#: Characters of a prefix that is kept as text.
PLAIN = 64
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9F3A6C71
#: Rows in a batch of rotations.
ROTATIONS = 20_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: First byte of the characters from U+00C0 to U+00FF.
_LEAD = 0xC3
#: Bytes that no run holds and at which a text may be cut: ASCII beside letters, and first bytes of other characters.
_CUT = ~_LETTER
_CUT[128:192] = _CUT[_LEAD] = False


def crc_steps() -> np.ndarray:
    """What each byte does to a crc32."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


_STEPS = crc_steps()


def crc32_of(seeds: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of the bytes in [start, end), going on from the crc32 of what comes before; long ranges one by one."""
    out = seeds.copy()
    sizes = ends - starts
    for i in np.flatnonzero(sizes > PLAIN):
        out[i] = zlib.crc32(buf[starts[i] : ends[i]], int(seeds[i]))
    short = np.flatnonzero(sizes <= PLAIN)
    short = short[np.argsort(-sizes[short], kind="stable")]
    state, at, left = ~seeds[short], starts[short], sizes[short]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k))  # ranges with more than k bytes come first
        state[:n] = _STEPS[(state[:n] ^ buf[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[short] = ~state
    return out


def word_counts(docs: DataFrame, every: int = 31, shortest: int = 7) -> DataFrame:
    """(word, n): the words of all texts of at least ``shortest`` characters."""
    kind = [("word", pa.string()), ("n", pa.int64())]

    def work(batches):
        for b in pieces(batches, 2 << 20):
            whole, borders = utf8(b.column("text"))
            ids = b.column("doc_id").to_pylist()
            seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            for lo, hi in B.slabs(whole, borders, _CUT, 2 << 20):
                buf = B.LOWER[whole[lo:hi]]
                offsets = np.clip(borders - lo, 0, hi - lo)
                held = _LETTER[buf]
                lead = buf == _LEAD
                held |= lead
                held[1:] |= lead[:-1]
                starts, ends = B.word_bounds(held, offsets)
                further = np.concatenate([[0], np.cumsum((buf & 0xC0) == 0x80, dtype=np.int32)])
                size = ends - starts - (further[ends] - further[starts])
                long = size >= shortest
                starts, ends, size = starts[long], ends[long], size[long]
                crc = crc32_of(seeds[B.rows_of(starts, offsets)], buf, starts, ends)
                cut = crc % np.uint32(every) == 0
                changed = []
                for i in np.flatnonzero(cut & (size > shortest)):
                    word, at = buf[starts[i] : ends[i]].tobytes().decode(), int(crc[i]) % int(size[i])
                    changed.append(word[:at] + word[at + 1 :])
                sizes = (ends - starts)[~cut]
                plain = texts(buf[B.ranges(starts[~cut], sizes)], np.concatenate([[0], np.cumsum(sizes)]))
                counted = pc.value_counts(pa.concat_arrays([plain, pa.array(changed, pa.string())]))
                yield table(kind, counted.field("values"), counted.field("counts"))

    found = mapped(docs.select("doc_id", "text"), work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def entries(word: str) -> Iterator[tuple[str, int]]:
    """Prefixes of the word's rotations with their kind: 0 the whole rotation, 1 and 2 the rotation without its last
    character, 2 if the same character stands before it in the word."""
    n = len(word)
    kinds = [1 + (i > 0 and word[i] == word[i - 1]) for i in range(n)]
    if n <= PLAIN:
        for i, kind in enumerate(kinds):
            yield word[i + 1 :] + END + word[:i], kind
    if n < PLAIN:
        for i in range(n + 1):
            yield word[i:] + END + word[:i], 0
        return
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * BASE + ord(c)) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)

    def name(i: int, j: int) -> str:
        """Of word[j:], terminator, word[:i]."""
        tail = sums[n] - sums[j] * powers[n - j]
        return f"{END}{n - j + 1 + i}:{(tail * powers[i] * BASE + ord(END) * powers[i] + sums[i]) % PRIME:x}"

    if n > PLAIN:
        for i, kind in enumerate(kinds):
            yield name(i, i + 1), kind
    for i in range(n + 1):
        yield name(i, i), 0


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, id, n, kind), sorted by prefix, then by count, largest first, and id."""
    kind = [("prefix", pa.string()), ("id", pa.int64()), ("n", pa.int64()), ("kind", pa.int8())]

    def work(batches):
        held: tuple[list, list, list, list] = [], [], [], []
        for b in batches:
            for word, id, n in zip(*(b.column(c).to_pylist() for c in ("word", "id", "n"))):
                for prefix, k in entries(word):
                    held[0].append(prefix)
                    held[3].append(k)
                    if len(held[0]) == ROTATIONS:
                        new = ROTATIONS - len(held[1])
                        held[1].extend([id] * new)
                        held[2].extend([n] * new)
                        yield table(kind, *held)
                        for part in held:
                            part.clear()
                new = len(held[0]) - len(held[1])
                held[1].extend([id] * new)
                held[2].extend([n] * new)
        if held[0]:
            yield table(kind, *held)

    rows = mapped(words.select("word", "id", "n"), work, "prefix string, id long, n long, kind byte", 5000)
    return rows.repartition("prefix").sortWithinPartitions("prefix", F.desc("n"), "id")


def group_neighbours(ids: np.ndarray, n: np.ndarray, kind: np.ndarray, new: np.ndarray):
    """Per row of sorted groups: how many of the group are near it, and the first of them (len(ids) if none)."""
    none, at = len(ids), np.arange(len(ids))
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1

    def first(rows):
        return np.minimum.reduceat(np.where(rows, at, none), heads)

    def count(rows):
        return np.bincount(group[rows], minlength=len(heads))

    skipped, single, whole = kind > 0, kind == 1, kind == 0
    best = first(skipped)[group]
    other = first(skipped & (at != best))[group]
    replaced = np.where(at == best, other, best)
    near = np.where(whole, count(single)[group], count(skipped)[group] - 1 + np.where(single, count(whole)[group], 0))
    shorter = np.where(single, first(whole)[group], none)
    return near, np.where(whole, first(single)[group], np.minimum(replaced, shorter))


def scan(sorted_rotations: DataFrame) -> DataFrame:
    """(id, near, form_n, form): a row for each word and group in which it has neighbours."""
    kind = [("id", pa.int64()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.int64())]

    def answer(rows: pa.RecordBatch):
        prefix = rows.column("prefix")
        new = np.ones(rows.num_rows, bool)
        new[1:] = pc.not_equal(prefix.slice(1), prefix.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        alone = new & np.append(new[1:], True)
        ids, n, kinds = (rows.column(c).to_numpy()[~alone] for c in ("id", "n", "kind"))
        if len(ids) == 0:
            return
        near, best = group_neighbours(ids, n, kinds, new[~alone])
        some = near > 0
        yield table(kind, ids[some], near[some], n[best[some]], ids[best[some]])

    def work(batches):
        held = None
        for b in batches:
            b = b if held is None else pa.concat_batches([held, b])
            prefix = b.column("prefix")
            last = b.num_rows - 1
            inside = pc.not_equal(prefix, prefix[last]).to_numpy(zero_copy_only=False)
            stop = int(np.count_nonzero(inside))  # rows are sorted, so the last group starts there
            yield from answer(b.slice(0, stop)) if stop else ()
            held = b.slice(stop)
        if held is not None and held.num_rows:
            yield from answer(held)

    return mapped(sorted_rotations, work, "id long, near long, form_n long, form long", ROTATIONS)


def roots(forms: DataFrame) -> DataFrame:
    """(id, root): forms followed to the last, for words that have one; each round doubles the steps taken."""
    todo = forms.select("id", F.col("form").alias("root"))
    while True:
        todo = stored(todo, "roots")
        onward = todo.select(F.col("id").alias("root"), F.col("root").alias("further"))
        if todo.join(onward, "root", "left_semi").isEmpty():
            return todo
        todo = todo.join(onward, "root", "left").select("id", F.coalesce("further", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Per row of ``words`` (word, n): word, n, n_near, form, form_n, root. Words are distinct and without "\\0"."""
    numbered = words.select("word", "n").orderBy("word").withColumn("id", F.monotonically_increasing_id())
    numbered = stored(numbered, "words")
    found = scan(rotations(numbered))
    best = F.max(F.struct("form_n", (-F.col("form")).alias("later"))).alias("best")
    merged = found.groupBy("id").agg(F.sum("near").alias("n_near"), best)
    merged = stored(merged.select("id", "n_near", "best.form_n", (-F.col("best.later")).alias("form")), "neighbours")
    listed = numbered.join(merged, "id", "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    listed = listed.withColumns({"form": F.when(fits, F.col("form")), "form_n": F.when(fits, F.col("form_n"))})
    listed = stored(listed, "forms")
    ends = roots(listed.where(F.col("form").isNotNull()))

    def named(column: str) -> DataFrame:
        return numbered.select(F.col("id").alias(column), F.col("word").alias(f"{column}_word"))

    spelled = ends.join(listed.select("id", "form"), "id").join(named("form"), "form").join(named("root"), "root")
    spelled = spelled.select("id", F.col("form_word").alias("form"), F.col("root_word").alias("root"))
    result = listed.drop("form").join(spelled, "id", "left")
    return result.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form", "form_n", F.coalesce("root", "word").alias("root"),
    )


def variants_of(docs: DataFrame, every: int = 31, shortest: int = 7, least: int = 2, ratio: int = 10) -> DataFrame:
    """The words of all texts with at least ``least`` occurrences, and their variants."""
    return spelling_variants(word_counts(docs, every, shortest).where(F.col("n") >= least), ratio)
