"""Near duplicates by SuperMinHash signatures, bands, verification on full sets, and union-find.

* Signature: every element deals itself a random permutation of the slots, and at step k offers k plus a random
  fraction to its k-th slot; a slot keeps its smallest offer. The ranks of an element are correlated (each slot once), so
  the estimate varies less than with independent hashes. A document stops at the first step that can't lower any slot.
* Documents with the same set are one class from the start, however many they are.
* Classes meet in bands of the signature. In each bucket all are compared with one of them, first with the one that meets most
  others (the original of many copies), then with another, some rounds long; those that are in one component by then need no
  more. Of the classes left in buckets of several components, those are compared that share a rare shingle: with all shingles
  ordered by how many of these classes hold them, a link shares one of the first few of both sets, however many are
  shared by all. Holders of such a shingle are compared with one of them first, round by round; then, of what is still
  apart, the pairs whose sizes and places leave the similarity possible. No link is given up, tight groups of any size cost a
  few comparisons per member, and classes that share a common passage and differ elsewhere make no pairs.
* A pair is a link if the Jaccard similarity of the full sets of shingles is at least the threshold. Labels of connected
  documents are found by stars in Spark.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. A document is an id and a text
(by a 64-bit hash of both), so rows with the same id, or none, and different texts are linked each by its own. Of a component
the document of the smallest id is kept (null last, then by hash), and its id names the component. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgauge.llm import bytesops as B
from landgauge.llm.common import discard, lists, mapped, pieces, stored, table, utf8
from landgauge.llm.components import components, nearby_labels

#: Rounds in which buckets, and then holders of rare shingles, are compared with one member each, before the rest is compared in full.
STAR_ROUNDS = 2


def document_key() -> Column:
    """Names a document: its id (or that it has none) and its text; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of all texts, sorted within each text, and the size of each text's set."""
    buf, offsets = utf8(column)
    starts, ends = B.word_bounds(~B.BLANK[buf], offsets)
    row = B.rows_of(starts, offsets)
    low = B.LOWER[buf]
    hashes = B.range_hash(B.prefix_sums(low), starts, ends, low)
    n = np.bincount(row, minlength=len(column))
    first = np.cumsum(n) - n
    whole = B.chain(hashes, width)
    inside = row[: len(whole)] == row[width - 1 : width - 1 + len(whole)]
    found, owner = [whole[inside]], [row[: len(whole)][inside]]
    for k in range(1, width):
        short = np.flatnonzero(n == k)
        if len(short):
            found.append(B.chain(hashes, k)[first[short]])
            owner.append(short)
    shingles, owner = np.concatenate(found), np.concatenate(owner)
    if len(found) > 1:
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(column)))
    start = 0
    for end in ends.tolist():
        shingles[start:end].sort()
        start = end
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.bincount(owner[new], minlength=len(column))


def draws(elements: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Two random numbers in [0, 1) of each element at a step."""
    x = B.mix(elements + np.uint64(0xD1B54A32D192ED03 * (2 * step + 1) % (1 << 64)))
    y = B.mix(x ^ np.uint64(0x94D049BB133111EB))
    unit = 1.0 / (1 << 53)
    return (x >> np.uint64(11)) * unit, (y >> np.uint64(11)) * unit


def signatures(elements: np.ndarray, sizes: np.ndarray, slots: int) -> np.ndarray:
    """The SuperMinHash signature of each set; empty sets keep infinity."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    out = np.full(n * slots, np.inf)
    swaps: list[np.ndarray] = []
    for step in range(slots):
        fraction, place = draws(elements, step)
        at = step + np.minimum((place * (slots - step)).astype(np.int64), slots - step - 1)
        slot = at
        # What stands at a place now, from the swaps so far, last one first.
        for k in range(step - 1, -1, -1):
            slot = np.where(slot == swaps[k], k, slot)
        np.minimum.at(out, owner * slots + slot, fraction + step)
        worst = out.reshape(n, slots).max(1)
        # The next step offers step + 1 and more.
        active = (worst > step + 1)[owner]
        if not active.any():
            break
        swaps.append(at.astype(np.int16))
        if not active.all():
            elements, owner = elements[active], owner[active]
            swaps = [s[active] for s in swaps]
    return out.reshape(n, slots)


def sketch(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: id, doc_id, n_shingles, two sums that identify the set, and its band keys."""
    kind = [
        ("id", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sum_a", pa.int64()), ("sum_b", pa.int64()), ("bands", pa.list_(pa.int64()))
    ]

    def work(batches):
        for b in pieces(batches, 2 << 20):
            shingles, sizes = shingle_sets(b.column("text"), width)
            ends = np.cumsum(sizes)
            sums = []
            for x in (shingles, B.mix(shingles ^ np.uint64(B.STEP))):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
                sums.append((total[ends] - total[ends - sizes]).view(np.int64))
            held = signatures(shingles, sizes, bands * rows).view(np.uint64).reshape(len(sizes), bands, rows)
            keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sizes), bands)).copy()
            for k in range(rows):
                keys = B.mix(keys * np.uint64(B.STEP) + held[:, :, k])
            each = np.where(sizes > 0, bands, 0)
            flat = keys[sizes > 0].ravel().view(np.int64)
            yield table(kind, b.column("id"), b.column("doc_id"), sizes, *sums, lists(flat, each, pa.int64()))

    return mapped(docs, work, "id long, doc_id long, n_shingles long, sum_a long, sum_b long, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    kind = [("id", pa.int64()), ("shingles", pa.list_(pa.int64()))]

    def work(batches):
        for b in pieces(batches):
            shingles, sizes = shingle_sets(b.column("text"), width)
            yield table(kind, b.column("id"), lists(shingles.view(np.int64), sizes, pa.int64()))

    return mapped(docs, work, "id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that are links, compared on their full sets."""
    second = pairs.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    both = second.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
    common = F.size(F.array_intersect("a", "b")).alias("common")
    measured = both.select("u", "v", common, (F.size("a") + F.size("b")).alias("total"))
    # 100 * intersection >= percent * union, in whole numbers.
    return measured.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("u", "v")


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(s, id, n, at, short): the shingles by which a link to each set can be found, with their places in the common order.

    Two sets that are links share a shingle that is among the first n - ceil(t n) + 1 of the larger and the first
    n - ceil(2 t n / (1 + t)) + 1 of the smaller one (``short`` marks those), t being the similarity. Shingles of one set only come
    first in the order and are left out.
    """
    each = sets.select("id", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("sets")).where(F.col("sets") > 1)
    shared = each.join(held, "s")
    of_set = Window.partitionBy("id")
    place = F.row_number().over(of_set.orderBy("sets", "s")) - 1
    own = F.col("n") - F.count("*").over(of_set)
    placed = shared.select("s", "id", "n", (own + place).cast("long").alias("at"))
    long = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1
    short = F.col("n") - F.expr(f"(2 * {percent} * n + {99 + percent}) div {100 + percent}") + 1
    return placed.where(F.col("at") < long).withColumn("short", F.col("at") < short)


def possible_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """(u, v): holders of a rare shingle in different components whose sizes and places allow the similarity."""
    small = rare.where("short").select("s", F.col("id").alias("u"), F.col("n").alias("nu"), F.col("at").alias("au"), F.col("label").alias("lu"))
    large = rare.select("s", F.col("id").alias("v"), F.col("n").alias("nv"), F.col("at").alias("av"), F.col("label").alias("lv"))
    ordered = (F.col("nu") < F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("u") < F.col("v")))
    sized = 100 * F.col("nu") >= percent * F.col("nv")
    # What both have from here on, if this is the first shingle they share.
    left = F.least(F.col("nu") - F.col("au"), F.col("nv") - F.col("av"))
    placed = (100 + percent) * left >= percent * (F.col("nu") + F.col("nv"))
    return small.join(large, "s").where((F.col("lu") != F.col("lv")) & ordered & sized & placed).select("u", "v").distinct()


def mixed(rows: DataFrame, key: str) -> DataFrame:
    """The rows of groups with more than one label."""
    groups = rows.groupBy(key).agg(F.min("label").alias("a"), F.max("label").alias("b")).where(F.col("a") != F.col("b"))
    return rows.join(groups.select(key), key)


def star_pairs(rows: DataFrame, key: str, rank: Column) -> DataFrame:
    """(u, v): the members of each group of ``key`` with the one of largest rank, if their labels differ."""
    centre = rows.groupBy(key).agg(F.max_by(F.struct("id", "label"), rank).alias("centre"))
    met = rows.join(centre, key).where(F.col("label") != F.col("centre.label"))
    return met.select(F.col("id").alias("u"), F.col("centre.id").alias("v"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, rows: int = 4) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    return near_groups(docs, width, percent, bands, rows).drop("id")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, rows: int = 4) -> DataFrame:
    """The same, with the document's key as id."""
    docs = docs.select(document_key().alias("id"), "doc_id", "text")
    found = stored(sketch(docs, width, bands, rows), "sketches")
    same = ["n_shingles", "sum_a", "sum_b"]
    first = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "id")
    classes = stored(found.where(F.col("n_shingles") > 0).groupBy(*same).agg(F.min("id").alias("head"), F.min(first).alias("first")), "classes")
    heads = found.join(classes, same).where(F.col("id") == F.col("head")).select("id", "n_shingles", F.explode("bands").alias("band"))
    members = heads.distinct()
    crowded = members.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(members.join(crowded, "band"), "members")
    # In how many places a class meets others: the original of many copies comes first.
    met = members.groupBy("id").agg(F.sum("n").alias("met"))
    members = stored(members.drop("n").join(met, "id"), "members")
    sizes = members.select("id", "n_shingles").distinct()
    none = members.select(F.col("id").alias("u"), F.col("id").alias("v")).limit(0)
    done, links, labels = none, none, none.toDF("id", "label")

    def likely(pairs: DataFrame) -> DataFrame:
        """New pairs whose sizes leave the similarity possible."""
        left = sizes.select(F.col("id").alias("u"), F.col("n_shingles").alias("nu"))
        right = sizes.select(F.col("id").alias("v"), F.col("n_shingles").alias("nv"))
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        joined = pairs.join(done, ["u", "v"], "left_anti").join(left, "u").join(right, "v")
        return joined.where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")).select("u", "v")

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))

    def link(pairs: DataFrame, sets: DataFrame | None = None) -> None:
        """Compare the pairs that are new, and label what they connect: enough to leave out pairs, exact only at the end."""
        nonlocal done, labels, links
        pairs = stored(likely(pairs), "pairs")
        if pairs.isEmpty():
            return
        held = sets
        if held is None:
            needed = pairs.select("u").union(pairs.select("v")).distinct().toDF("id")
            held = stored(full_sets(docs.join(stored(needed, "pair-ids"), "id").dropDuplicates(["id"]), width), "sets")
        new = stored(verified(pairs, held, percent), "links")
        if sets is None:
            discard(held)
        if not new.isEmpty():
            labels, links = nearby_labels(labels.toDF("u", "v").unionByName(new)), links.unionByName(new)
        done = done.unionByName(pairs)

    def rank(turn: int, key: str) -> Column:
        return F.struct(F.xxhash64("id", key, F.lit(turn)), F.col("id"))

    open_rows = members.withColumn("label", F.col("id"))
    for turn in range(STAR_ROUNDS):
        if turn:
            open_rows = stored(mixed(labelled(members), "band"), "open")
        if open_rows.isEmpty():
            break
        link(star_pairs(open_rows, "band", rank(turn, "band") if turn else F.struct("met", F.bitwise_not("id"))))
    open_ids = stored(mixed(labelled(members), "band").select("id").distinct(), "open-ids")
    if not open_ids.isEmpty():
        sets = stored(full_sets(docs.join(open_ids, "id").dropDuplicates(["id"]), width), "sets")
        rare = stored(rare_shingles(sets, percent), "rare-shingles")
        for turn in range(STAR_ROUNDS + 1):
            apart = stored(mixed(labelled(rare), "s"), "apart")
            if apart.isEmpty():
                break
            if turn < STAR_ROUNDS:
                # One id is the centre wherever it ranks first, so neighbouring shingles ask for the same pairs.
                link(star_pairs(apart, "s", F.struct(F.xxhash64("id", F.lit(turn)), F.col("id"))), sets)
            else:
                link(possible_pairs(apart, percent), sets)
            discard(apart)
        discard(rare)
        discard(sets)
    labels = components(links).withColumnRenamed("id", "head")
    firsts = classes.join(labels, "head").groupBy("label").agg(F.min("first").alias("least"))
    named = classes.join(labels, "head", "left").join(stored(firsts, "firsts"), "label", "left")
    named = named.select(*same, F.coalesce("least", "first").alias("first"))
    result = found.join(named, same, "left").withColumn("first", F.coalesce("first", first))
    return result.select(
        "id", "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col("id") == F.col("first.id")).alias("kept")
    )
