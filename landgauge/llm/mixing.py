"""Mixing sources to target weights by Sainte-Lague apportionment.

* Targets: the sources share all words by weight, and no source gets more than ``cap`` times what it has; what is
  above goes to the others, by weight, until none is above.
* Seats: the targets are cut into blocks of ``block`` words. Blocks go to sources by the highest quotients
  target / (2k + 1), and a source's blocks to its shards (about ``SHARD_WORDS`` words each) in the same way.
* Selection: a shard's documents stand in a seeded order on one line of words. Its quota is a run of blocks from a
  seeded block on, round and round: whole laps take every document once more, the rest of the run takes a stretch.

The highest quotients are found without listing them: a divisor is bracketed from seat totals on a grid, until the few
seats between both ends of the bracket can be ranked. No step holds all documents or all seats in one task.

A null text has no words; sources are told apart by code point, null is a source of its own and comes last. Repeated ids
are documents of their own. Documents without words take nothing. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgauge.llm.common import WORD, stored

SHARD_WORDS = 1 << 20
GRID = 32


def seeded(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its place (from 0) in the order, found from range partitions and their sizes."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("place", 33).alias("part")
    sizes = ranged.groupBy(part).agg(F.count("*").alias("n"))
    # One row per partition, not per source.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = F.col("place").bitwiseAND((1 << 33) - 1)
    return ranged.withColumn("part", part).join(sizes, "part").withColumn("place", local + F.col("before")).drop("part", "before")


def targets(sources: DataFrame, cap: int) -> DataFrame:
    """``sources`` (size, weight) with target."""
    total, weights = sources.agg(F.sum("size"), F.sum("weight")).first()
    rest, left, share = total or 0, weights or 1, None
    while True:
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(left or 1))
        above = share > cap * F.col("size")
        taken, weight = sources.agg(
            F.coalesce(F.sum(F.when(above, cap * F.col("size"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        now = (total or 0) - taken, weight
        if now == (rest, left) or not weight:
            return sources.withColumn("target", F.when(above, cap * F.col("size").cast("double")).otherwise(share))
        rest, left = now


def sainte_lague(items: DataFrame) -> DataFrame:
    """``items`` (party, item, votes double, seats of the party, cap of the item) with ``won`` added.

    Within a party, seats go to the items with the highest votes / (2k + 1), ties to the smaller item, none above its cap.
    """
    seats_at = lambda d: F.least(F.col("cap"), F.floor(F.col("votes") / d + 0.5))
    live = (F.col("votes") > 0) & (F.col("cap") > 0)
    bounds = items.where(live).groupBy("party").agg(
        F.least(F.max("seats"), F.sum("cap")).alias("wanted"),
        (F.min(F.col("votes") / (F.col("cap") + 1)) * 0.999).alias("low"),
        (F.max("votes") * 2.001).alias("high"),
        F.count("*").alias("n"),
    )
    bounds = stored(bounds, "bracket")
    for _ in range(16):
        grid = F.explode(F.sequence(F.lit(0), F.lit(GRID))).alias("i")
        steps = bounds.select("party", "wanted", "low", "high", "n", grid)
        steps = steps.withColumn("d", F.col("low") * F.pow(F.col("high") / F.col("low"), F.col("i") / F.lit(float(GRID))))
        counted = items.where(live).join(steps, "party").groupBy("party", "wanted", "n", "d").agg(F.sum(seats_at(F.col("d"))).alias("sum"))
        over, under = F.col("sum") >= F.col("wanted"), F.col("sum") <= F.col("wanted")
        bounds = counted.groupBy("party", "wanted", "n").agg(
            F.max(F.when(over, F.col("d"))).alias("low"),
            F.min(F.when(under, F.col("d"))).alias("high"),
            F.min(F.when(over, F.col("sum"))).alias("most"),
            F.max(F.when(under, F.col("sum"))).alias("least"),
        )
        # At both ends of a bracket totals may round past the party's seats; such an end stays as it was.
        bounds = stored(bounds.withColumn("high", F.coalesce("high", "low")).withColumn("low", F.coalesce("low", "high")), "bracket")
        if bounds.where(F.col("most") - F.col("least") > 2 * F.col("n")).isEmpty():
            break
    ends = bounds.select("party", "wanted", "low", "high")
    both = items.join(ends, "party", "left").withColumn("live", live & F.col("low").isNotNull())
    both = both.withColumn("sure", F.when(F.col("live"), F.least(seats_at(F.col("high")), seats_at(F.col("low")))).otherwise(0))
    both = stored(both.withColumn("maybe", F.when(F.col("live"), seats_at(F.col("low"))).otherwise(0)), "seats")
    open_seats = both.groupBy("party").agg((F.max("wanted") - F.sum("sure")).alias("open"))
    spare = both.where(F.col("maybe") > F.col("sure")).select(
        "party", "item", "votes", F.explode(F.sequence("sure", F.col("maybe") - 1)).alias("k")
    )
    ranked = Window.partitionBy("party").orderBy(F.desc(F.col("votes") / (2 * F.col("k") + 1)), "item", "k")
    more = spare.withColumn("rank", F.row_number().over(ranked)).join(open_seats, "party").where(F.col("rank") <= F.col("open"))
    more = more.groupBy("party", "item").agg(F.count("*").alias("more"))
    done = both.join(more, ["party", "item"], "left")
    return done.withColumn("won", F.col("sure") + F.coalesce("more", F.lit(0))).select(*items.columns, "won")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), block: int = 8, cap: int = 3, seed: int = 1) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, laps (times it is taken whole).

    The ``weights`` repeat over the sources in the order of their names.
    """
    key = F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), "source")).alias("key")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sized = stored(docs.select("doc_id", "source", key, words.alias("size")), "sizes")
    sources = sized.groupBy("key", "source").agg(F.sum("size").alias("size"))
    sources = numbered(sources, F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(targets(stored(sources.withColumn("weight", weight), "sources"), cap), "targets")

    about = sources.select("key", F.col("size").alias("source_size"), "target", "place")
    digest = seeded(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    lined = sized.join(about, "key").withColumn("digest", digest)
    shards = 1 + F.floor(F.col("source_size") / SHARD_WORDS)
    lined = lined.withColumn("shard", F.pmod(number(F.col("digest")), shards))
    held = stored(lined.groupBy("key", "place", "target", "shard").agg(F.sum("size").alias("shard_size")), "shards")
    room = F.floor(cap * F.col("shard_size") / block)
    total = sources.agg(F.sum("size")).first()[0] or 0
    parties = held.groupBy("key", "place", "target").agg(F.sum(room).alias("cap"))
    parties = parties.select(
        F.lit(0).alias("party"), F.col("place").alias("item"), F.col("target").alias("votes"),
        F.lit((2 * total + block) // (2 * block)).alias("seats"), "cap", "key",
    )
    won = stored(sainte_lague(parties).select("key", F.col("won").alias("seats")), "source-seats")
    within = held.join(won, "key").select(
        F.col("key").alias("party"), F.col("shard").alias("item"), F.col("shard_size").cast("double").alias("votes"),
        "seats", room.alias("cap"), "shard_size",
    )
    quotas = sainte_lague(within).select(
        F.col("party").alias("key"), F.col("item").alias("shard"), "shard_size", (F.col("won") * block).alias("quota")
    )
    first = F.pmod(number(seeded(F.lit(seed), F.lit("start"), F.col("key"), F.col("shard"))), F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block))) * block
    quotas = stored(quotas.withColumn("first", first), "quotas")

    line = Window.partitionBy("key", "shard").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = lined.withColumn("end", F.sum("size").over(line)).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.join(quotas, ["key", "shard"])
    laps = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
    run_end = F.col("first") + F.col("quota") - F.col("laps") * F.col("shard_size")
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(F.col("end"), b) - F.greatest(F.col("start"), a))
    stretch = overlap(F.col("first"), F.least(run_end, F.col("shard_size"))) + overlap(F.lit(0), run_end - F.col("shard_size"))
    placed = placed.withColumn("laps", laps)
    taken = (F.col("laps") * F.col("size") + F.when(F.col("size") > 0, stretch).otherwise(0)).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.col("laps").cast("long").alias("laps"))
