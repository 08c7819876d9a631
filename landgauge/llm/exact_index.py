"""Exact duplicates through an extendible-hash index on shared files. DataFrame functions only.

* Every text gets a 64-bit pseudo key. A bucket is a prefix of the key; a bucket with more than ``capacity``
  keys is split by its next bit, and the directory doubles until no bucket is overfull. Keys are counted
  once each, so copies never fill a bucket.
* The directory routes keys to buckets. Owners hold ranges of buckets and keep their keys, sorted, in one
  file each of a shared folder.
* Texts with the same key form a chain. The text of the smallest id heads it and is compared with the others
  byte by byte; those that differ go on to the next chain, until none is left.

Null text counts as empty. A null id counts as larger than all others. Rows that repeat an id and its text
share one result. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so other columns may
have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.llm.common import SPACE, stored

LAST = 9223372036854775807


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def prefix(key: Column, bits: int) -> Column:
    """The first bits of a key."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def split_buckets(keys: DataFrame, capacity: int, step: int = 8) -> DataFrame:
    """Buckets as (depth, prefix, keys): the shortest prefixes that hold at most ``capacity`` keys.

    The directory grows by ``step`` doublings a round; later rounds count only keys of overfull buckets.
    """
    found, depth, todo = None, 0, keys.select("h")
    while True:
        depth += step
        # Counts at the deepest level of this round give those of all levels above.
        leaves = todo.groupBy(prefix(F.col("h"), depth).alias("leaf")).agg(F.count("*").alias("n"))
        level = leaves.select("n", "leaf", F.explode(F.sequence(F.lit(depth - step), F.lit(depth))).alias("depth"))
        level = level.select("depth", F.expr(f"shiftright(leaf, {depth} - depth)").alias("prefix"), "n")
        nodes = stored(level.groupBy("depth", "prefix").agg(F.sum("n").alias("keys")), "nodes")
        full = nodes.where(F.col("keys") > capacity)
        parents = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fits = nodes.where(F.col("keys") <= capacity).withColumn("parent", F.shiftright("prefix", 1))
        good = fits.join(parents, ["depth", "parent"], "left_semi")
        if depth == step:
            good = good.unionByName(fits.where(F.col("depth") == 0))
        good = good.select("depth", "prefix", "keys")
        found = good if found is None else found.unionByName(good)
        overfull = full.where(F.col("depth") == depth).select(F.col("prefix").alias("leaf"))
        if depth == 64 or overfull.isEmpty():
            return stored(found, "buckets")
        todo = todo.withColumn("leaf", prefix(F.col("h"), depth)).join(overfull, "leaf", "left_semi").select("h")


def directory(buckets: DataFrame) -> tuple[DataFrame, int]:
    """One pointer for each prefix of the global depth, and that depth. A bucket is named by its first pointer."""
    deepest = buckets.agg(F.max("depth")).first()[0] or 0
    room = F.expr(f"shiftleft(1L, {deepest} - depth)")
    first = F.expr(f"shiftleft(prefix, {deepest} - depth)")
    named = buckets.select(first.alias("bucket"), room.alias("room"))
    pointers = named.select("bucket", F.explode(F.sequence("bucket", F.col("bucket") + F.col("room") - 1)).alias("pointer"))
    return stored(pointers, "directory"), deepest


def build_index(entries: DataFrame, capacity: int = 4096) -> DataFrame:
    """The index: bucket, key and how many rows have it; owners' files hold ranges of buckets."""
    keys = stored(entries.groupBy("h").agg(F.count("*").alias("n")), "keys")
    pointers, deepest = directory(split_buckets(keys, capacity))
    routed = keys.withColumn("pointer", prefix(F.col("h"), deepest)).join(pointers, "pointer").drop("pointer")
    owned = routed.repartitionByRange("bucket").sortWithinPartitions("bucket", "h")
    return stored(owned, "index")


def duplicates(docs: DataFrame, capacity: int = 4096, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``key`` maps a normalised text to a long that is spread over all 64 bits; equal keys only make chains longer, never a
    wrong match.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), normalised(F.col("text")).alias("norm"))
    entries = stored(
        rows.select("id", key(F.col("norm")).cast("long").alias("h"), F.sha2("norm", 256).alias("text_sha256")), "entries"
    )
    index = build_index(entries, capacity)
    shared = stored(index.where(F.col("n") > 1).select("bucket", "h"), "shared-keys")
    keyed = rows.withColumn("h", key(F.col("norm")).cast("long"))
    todo = stored(keyed.join(shared, "h"), "chains")
    matched = None
    while True:
        heads = todo.groupBy("bucket", "h").agg(F.min("id").alias("head"))
        heads = todo.join(heads, ["bucket", "h"]).where(F.col("id") == F.col("head"))
        heads = heads.groupBy("bucket", "h", "head").agg(F.min("norm").alias("head_norm"))
        pairs = todo.join(heads, ["bucket", "h"]).select("id", "h", "head", (F.col("norm") == F.col("head_norm")).alias("same"))
        compared = stored(pairs, "compared")
        same = compared.where("same").select("id", "h", "head")
        matched = same if matched is None else matched.unionByName(same)
        differ = compared.where(~F.col("same")).select("id", "h").distinct()
        if differ.isEmpty():
            break
        todo = stored(todo.join(differ, ["id", "h"], "left_semi"), "chains")
    sizes = matched.groupBy("h", "head").agg(F.count("*").alias("rows"))
    linked = matched.distinct().join(sizes, ["h", "head"])
    result = entries.join(linked, ["id", "h"], "left")
    keep = F.coalesce("head", "id")
    return result.select(
        F.nullif("id", F.lit(LAST)).alias("doc_id"),
        F.nullif(keep, F.lit(LAST)).alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        (F.col("id") == keep).alias("kept"),
        "text_sha256",
    )
