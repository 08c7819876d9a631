"""What grows with the tables is dealt out: no broadcast of expanded rows, no single task for a whole table."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landgauge.catalog import parsing, plans, sources, streams, tables
from landgauge.catalog.registry import QUERIES
from landgauge.functions import parsing as P
from landgauge.operators import lsa, nearest, similar
from landgauge.plans import comparables, features
from landgauge.sources import tabular
from landgauge.schemas import TRADE_RAW


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_broadcasts_nothing(spark):
    # Small for the planner, but entered 27 times at every level of the grid.
    k = F.col("id")
    stations = spark.range(1_000).select(F.concat(F.lit("s"), k).alias("subway_name"), (33 + k * 617 % 1009 / 500).alias("lat"), (126 + k * 283 % 1013 / 500).alias("lng"))
    points = stations.select((F.col("lat") + 0.001).alias("lat"), "lng")
    found = nearest.nearest_by_grid(points, stations, "subway_name")
    assert "Broadcast" not in plan(found)
    assert found.count() == points.distinct().count()


def write_orders(spark, path):
    k = F.col("id")
    spark.range(3_000).select(k.alias("c_custkey"), (k % 25).cast("int").alias("c_nationkey")).coalesce(1).write.parquet(f"{path}/customer.parquet")
    day = F.date_add(F.lit("1995-01-31").cast("date"), (k % 700).cast("int")).cast("timestamp")
    spark.range(3_000).select(k.alias("o_orderkey"), k.alias("o_custkey"), day.alias("o_orderdate")).coalesce(1).write.parquet(f"{path}/orders.parquet")


def tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_one_row_group_feeds_many_tasks(spark, tmp_path):
    write_orders(spark, tmp_path)
    assert tasks_with_rows(tables.properties(spark, tmp_path)) > 8
    assert tasks_with_rows(sources.building_answers(spark, tmp_path)) > 8
    assert tasks_with_rows(parsing.trailing_months(spark, tmp_path)) > 8


def test_routed_answers_are_parsed_once(spark, tmp_path):
    write_orders(spark, tmp_path)
    routed = streams.route_answers(spark, tmp_path)
    assert routed._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation") == 2
    assert routed.agg(F.sum("answers")).first()[0] == 3_000


def test_trailing_months_of_all_years(spark):
    days = ["1995-01-31", "2004-02-29", "1003-01-01", "1004-12-31", "0950-07-01", "9999-12-31", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    last = F.trunc("d", "MM")
    plain = F.transform(F.sequence(F.add_months(last, -59), last, F.expr("interval 1 month")), lambda m: F.date_format(m, "yyyyMM"))
    got = rows.select("d", P.trailing_months("d").alias("got"), plain.alias("plain")).collect()
    assert all(r.got == r.plain for r in got)


def test_list_search_equals_grid_search(spark):
    k = F.col("id")
    points = spark.range(500).select((33 + k * 617 % 1009 / 500).alias("lat"), (126 + k * 283 % 1013 / 500).alias("lng"))
    stations = spark.range(40).select(F.concat(F.lit("s"), k).alias("subway_name"), (33 + k * 71 % 41 / 20).alias("lat"), (126 + k * 13 % 43 / 20).alias("lng"))
    a = nearest.nearest_by_list(points, stations, "subway_name").collect()
    b = nearest.nearest_by_grid(points, stations, "subway_name").collect()
    assert sorted((r.lat, r.lng, r._near.name) for r in a) == sorted((r.lat, r.lng, r._near.name) for r in b)


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    names = TRADE_RAW.names
    for k, order in enumerate((names, names[::-1])):
        lines = [",".join(order), ",".join(f"{n}{k}" for n in order), ",".join(order[:-1]), '"half']
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{tmp_path}/{k}")
    spark.createDataFrame([("no header",), ("1,2",)], "value string").coalesce(1).write.text(f"{tmp_path}/none")
    rows, rejects = tabular.read_checked(spark, f"{tmp_path}/*/*.txt", TRADE_RAW)
    assert "SortMergeJoin" not in plan(rows) and plan(rows).count("from_csv") == 2  # once a layout
    assert sorted(r.jibun for r in rows.collect()) == ["jibun0", "jibun1"]
    assert rejects.count() == 2 * 2 + 2


def test_queries_travel_once_a_region(spark, monkeypatch):
    """Small blocks that rule out little: vectors are sent by regions, not by blocks."""
    rows = spark.range(600).select("id", F.array(*[((F.hash("id", F.lit(j)) % 1000) / 1000.0).cast("float") for j in range(32)]).alias("embedding"))
    search = similar.BlockSearch(rows, n=3, block_rows=20)
    sent, real = [], search._meet
    monkeypatch.setattr(search, "_meet", lambda visits: sent.append(visits.count()) or real(visits))
    _, report = search.answer(rows)
    assert search.blocks >= 30 and report.first().compared > 600 * 15
    assert sum(sent) <= 2 * 600


def test_only_terms_that_can_make_the_list_are_shuffled(spark, monkeypatch):
    """Terms of light buckets are never grouped; collisions, equal counts and texts without terms change nothing."""
    k = F.col("id")
    texts = spark.range(4_000).select(F.concat(F.lit("w"), k, F.lit(" common w"), k % 7, F.lit(" v"), k % 40).alias("t"))
    texts = texts.unionByName(spark.createDataFrame([("",), (None,)], "t string"))
    for buckets, most in ((5_000, 1_500), (16, None), (1, None)):
        kept, real = [], lsa.measured
        monkeypatch.setattr(lsa, "BUCKETS", buckets)
        monkeypatch.setattr(lsa, "measured", lambda df: kept.append(real(df)) or kept[-1])
        for max_terms in (1, 60, 50_000):
            terms = lsa.with_terms(texts, "t").select(F.explode("terms").alias("term"))
            want = terms.groupBy("term").count().orderBy(F.desc("count"), "term").limit(max_terms)
            got = lsa._most_used(terms, max_terms)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            if most and max_terms == 60:
                assert all(df.count() < most for df in kept if "uses" in df.columns)
            kept.clear()
        monkeypatch.setattr(lsa, "measured", real)


def test_rows_laid_out_give_the_same_products():
    """Full rows are multiplied as a dense matrix, thin ones by their terms; both give what a plain product gives."""
    rng = np.random.default_rng(3)
    for share, laid_out in ((0.3, True), (0.0004, False)):
        m = np.where(rng.random((300, 4_000)) < share, rng.normal(size=(300, 4_000)), 0)
        m[17] = 0
        idx = [np.flatnonzero(r).astype(np.int32) for r in m]
        columns = [pa.array(idx, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(m, idx)], pa.list_(pa.float64()))]
        batch = pa.RecordBatch.from_arrays(columns, names=["indices", "values"])
        block = rng.normal(size=(4_000, 9))
        assert any(p[5] is not None for p in lsa._products(batch, block)) == laid_out
        assert np.allclose(lsa._added(None, batch, block), m.T @ (m @ block))
        triangle = lsa._stacked(None, batch, block)
        assert np.allclose(triangle.T @ triangle, (m @ block).T @ (m @ block))


def test_encoders_are_fitted_from_rows_computed_once(spark, monkeypatch):
    seen, real = [], features.LabelEncoder.fit
    monkeypatch.setattr(features.LabelEncoder, "fit", lambda train, columns: seen.append(train.storageLevel.useMemory) or real(train, columns))
    names = ["mhouseNm", "umdNm", "sido", "region", "subway_name", "houseType"]
    numbers = ["buildYear", "Age", "floor", "dealYear", "dealMonth", "dealDay", "subway_dist", "Price_per_m2", "excluUseAr", "landAr"]
    more = ["parking_ratio", "has_elevator", "dealAmount", "total_floors"]
    rows = [(f"r{i}", *[f"{c}{i % 3}" for c in names], 1990.0 + i % 9, 3.0, 2.0, 2020, i % 12 + 1, i % 28 + 1, *[float(i)] * 4, 0.5, 1, 30_000, 4) for i in range(30)]
    df = spark.createDataFrame(rows, ["row_id", *names, *numbers, *more])
    encoded, _, _ = features.chronological_features(df, "row_id")
    assert seen == [True] and encoded.count() == 30


def test_batch_asks_every_twentieth_order_among_all_rows(spark, monkeypatch):
    k = F.col("id")
    rows = spark.range(200).select(k.alias("l_orderkey"), *[(k % 7 + i).alias(c) for i, c in enumerate(plans.KEYS[1:])])
    vectors = {f"{i}-{i % 7}-{i % 7 + 1}-{i % 7 + 2}": np.random.default_rng(i).normal(size=4).tolist() for i in range(200)}
    index = spark.createDataFrame(list(vectors.items()), "id string, embedding array<double>")
    monkeypatch.setattr(plans, "listings", lambda *_: rows)
    monkeypatch.setattr(plans, "embedding_index", lambda listed, row_id: listed.select(row_id).join(index, row_id))
    got = {(r.query_id, r.rank): r.id for r in plans.batch(spark, "").collect()}
    names, m = list(vectors), np.array(list(vectors.values()))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = {}
    for i in range(0, 200, 20):
        near = [j for j in np.argsort(-(m @ m[i])) if j != i][:3]
        want |= {(names[i], rank): names[j] for rank, j in enumerate(near, 1)}
    assert got == want


def test_batch_query_asks_for_all_rows(spark, monkeypatch):
    k = F.col("id")
    rows = spark.range(90).select(k.alias("l_orderkey"), *[(k % 7 + i).alias(c) for i, c in enumerate(plans.KEYS[1:])])
    m = np.random.default_rng(9).normal(size=(90, 4))
    names = [f"{i}-{i % 7}-{i % 7 + 1}-{i % 7 + 2}" for i in range(90)]
    index = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, m)], "id string, embedding array<double>")
    monkeypatch.setattr(plans, "listings", lambda *_: rows)
    monkeypatch.setattr(plans, "embedding_index", lambda listed, row_id: listed.select(row_id).join(index, row_id))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = [[j for j in np.argsort(-(m @ m[i])) if j != i][:3] for i in range(90)]
    want = {(names[i], rank): names[j] for i in range(90) for rank, j in enumerate(near[i], 1)}
    assert {(r.query_id, r.rank): r.id for r in QUERIES["plan_batch_comparables"](spark, "").collect()} == want


def test_planes_between_pivots_rule_out_blocks(spark):
    """Rows in all directions, each with close neighbours: few blocks are visited, and no row is missed."""
    rng = np.random.default_rng(10)
    m = (np.repeat(rng.normal(size=(500, 32)), 4, axis=0) + rng.normal(0, 1e-4, (2_000, 32))).astype(np.float32)
    m[:3] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<float>")
    found, report = similar.BlockSearch(df, n=3, block_rows=50).answer(df)
    work = report.first()
    assert work.compared < work.pairs / 20  # 7,658 by radii alone, 4,362 with the planes
    unit = m / np.maximum(np.linalg.norm(m.astype(float), axis=1, keepdims=True), 1e-300)
    got = {(r.query_id, r.rank): round(r.similarity, 6) for r in found.collect()}
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    best = -np.sort(-sims, axis=1)[:, :3]
    assert all(abs(got[q, k + 1] - best[q, k]) < 2e-6 for q in range(2_000) for k in range(3))


def test_comparables_of_odd_vectors(spark):
    """As the column form has it: missing, short, empty and incomplete vectors, and such without length."""
    vectors = [[3.0, 4.0], [0.6, 0.8], None, [1.0], [], [1.0, None], [0.0, 0.0], [-4.0, 3.0], [float("nan"), 1.0], [4.0, 3.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, embedding array<float>")
    plain = df.crossJoin(df.where("id = 0").select(F.col("embedding").alias("t"))).where("id <> 0 AND embedding IS NOT NULL")
    plain = plain.select("id", similar.cosine(F.col("embedding"), F.col("t")).alias("similarity"))
    want = plain.orderBy(F.desc("similarity"), "id").collect()
    got = similar.comparables(df, 0, 20)
    assert "ArrowEvalPython" in plan(got)
    assert [(r.id, str(round(r.similarity, 9))) for r in got.collect()] == [(r.id, str(round(r.similarity, 9))) for r in want]
    assert similar.comparables(df, 2, 3).count() == 0
    with pytest.raises(Exception, match="not unique"):
        similar.comparables(df.unionByName(df), 0, 3).collect()


def test_texts_of_the_index_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counting(v):
        made.add(1)
        return v

    counted = F.udf(counting, "string").asNondeterministic()
    rows = spark.range(70).select("id", F.concat(F.lit("w"), F.col("id") % 9, F.lit(" v"), F.col("id") % 5).alias("t"))
    index = comparables.embedding_index(rows.select("id", counted("t").alias("text")), "id", "text", 4)
    assert index.count() == 70 and made.value == 70


def test_zeros_of_both_signs_are_one_vector(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [1.0, -0.0])], "id long, embedding array<double>")
    got = {(r.query_id, r.rank): r.id for r in similar.batch_comparables(df, df).collect()}
    assert got == {(1, 1): 2, (1, 2): 3, (2, 1): 1, (2, 2): 3, (3, 1): 1, (3, 2): 2}
    search = similar.BlockSearch(df, 3)
    assert search.count == 2
    ranked = search.answer(df)[0]._jdf.queryExecution().executedPlan().toString()
    assert ranked.count("xxhash64(v#") >= 2  # queries are joined by hash first, as whole vectors are slow to sort by
