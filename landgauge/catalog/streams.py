"""Incremental ingestion over whole tables (ST*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.catalog.registry import query, scratch, table
from landgauge.catalog.sources import building_answers
from landgauge.sources.payloads import parse_building_answers
from landgauge.streaming import ingest

SCHEMA = T.StructType(
    [T.StructField("c_custkey", T.LongType()), T.StructField("payload", T.StringType())]
)


def _land(answers, folder: str, wave: int) -> None:
    answers.write.json(f"{folder}/wave={wave}")


@query(
    "st1_resumed_ingest",
    """SELECT c_custkey, c_custkey % 2 AS batch_id,
         CASE WHEN c_custkey % 20 = 0 THEN 'no_record' ELSE 'ok' END AS status
       FROM customer WHERE c_custkey % 20 NOT IN (1, 2, 3, 4)""",
)
def resumed_ingest(spark, sf):
    """Two waves of landed answers, taken in by three runs; the last one finds nothing new. Then a new checkpoint over
    the first wave alone: what it takes in again stands beside the older batches."""
    base = scratch(spark, "st1")
    landed, out, checkpoint = f"{base}/landed", f"{base}/out", f"{base}/checkpoint"
    answers = building_answers(spark, sf)
    for wave in (0, 1):
        _land(answers.where(F.col("c_custkey") % 2 == wave), landed, wave)
        ingest.ingest(spark, landed, SCHEMA, parse_building_answers, out, checkpoint)
    ingest.ingest(spark, landed, SCHEMA, parse_building_answers, out, checkpoint)
    ingest.ingest(spark, f"{landed}/wave=0", SCHEMA, parse_building_answers, out, f"{base}/second")
    rows = ingest.results(spark, out, ["c_custkey"])
    return rows.select("c_custkey", F.col("batch_id").cast("long").alias("batch_id"), "status")


@query(
    "st3_route_answers",
    """SELECT CASE WHEN c_custkey % 20 IN (1, 2, 3, 4) THEN 'rejected' ELSE 'accepted' END AS route,
         CASE c_custkey % 20 WHEN 0 THEN 'no_record' WHEN 1 THEN 'quota' WHEN 2 THEN 'parse_error' WHEN 3 THEN 'quota'
           WHEN 4 THEN 'service_error' ELSE 'ok' END AS status, count(*) AS answers FROM customer GROUP BY 1, 2""",
)
def route_answers(spark, sf):
    # Kept, so that each answer is parsed once and no route's filter is moved before the rows are dealt out.
    answers = parse_building_answers(building_answers(spark, sf)).persist()
    routes = [rows.withColumn("route", F.lit(name)) for name, rows in ingest.route(answers).items()]
    both = routes[0].unionByName(routes[1])
    return both.groupBy("route", "status").agg(F.count(F.lit(1)).alias("answers"))


@query(
    "st3_quota_reached",
    """SELECT count(*) FILTER (WHERE c_custkey % 20 IN (1, 3)) > 0 AS stop,
         count(*) FILTER (WHERE c_custkey % 20 IN (1, 3)) AS quota_answers FROM customer""",
)
def quota_reached(spark, sf):
    return ingest.quota_reached(parse_building_answers(building_answers(spark, sf)))


@query(
    "st1_next_requests",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer WHERE c_custkey % 20 IN (1, 3, 4)
       OR c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def next_requests(spark, sf):
    """Customers to ask for: without an order-borne answer, or with one that may be retried."""
    answers = parse_building_answers(building_answers(spark, sf))
    asked = answers.join(
        table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"
    )
    failed = F.when(F.col("status") == "parse_error", "EXCEPTION_PARSE").when(
        ~F.col("status").isin("ok", "no_record"), F.col("status")
    )
    return ingest.next_requests(
        table(spark, sf, "customer").select("c_custkey"), asked.withColumn("error", failed), ["c_custkey"]
    )
