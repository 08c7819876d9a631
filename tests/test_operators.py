"""Operators on small frames, against plain Python or brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from landgauge.functions.numeric import bits_value, ordered_bits, value_of_bits
from landgauge.operators import (
    encode, filters, impute, land_index, lookups, lsa, metrics, model, nearest, profile, regions, similar, split,
)


def test_filters_keep_null(spark):
    df = spark.createDataFrame([(1, "O"), (2, None), (3, "")], "id int, c string")
    assert [r.id for r in filters.drop_value(df, "c", "O").orderBy("id").collect()] == [2, 3]
    hit = filters.drop_matching(df, "c", "^o$").orderBy("id").collect()
    assert [r.id for r in hit] == [2, 3]
    prices = spark.createDataFrame([(3899,), (3900,), (82000,), (82001,), (None,)], "dealAmount long")
    assert filters.plausible_prices(prices).count() == 2


CODES = [
    ("4300000000", "충청북도"), ("4311000000", "충청북도 청주시"), ("4311100000", "충청북도 청주시 상당구"),
    ("4311200000", "충청북도 청주시 서원구"), ("4374000000", "충청북도 영동군"), ("4374500000", "충청북도 증평군"),
    ("1111000000", "서울특별시 종로구"),
]


def test_region_lookups(spark):
    codes = spark.createDataFrame(CODES, "code string, name string")
    look = {r.sggCd: (r.sido, r.region) for r in regions.region_lookup(codes).collect()}
    assert look[43111] == ("충북", "상당구") and look[11110] == ("서울", "종로구")
    assert look[43000] == ("충북", "충청북도")
    trades = spark.createDataFrame([(43111,), (43740,), (99999,)], "sggCd int")
    named = regions.attach_land_region(
        regions.attach_region(trades, regions.region_lookup(codes)), regions.parent_lookup(codes)
    )
    assert {r.sggCd: r.land_region for r in named.collect()} == {43111: "청주시", 43740: "영동군", 99999: None}


def test_leaf_regions_keep_a_county_with_a_shared_prefix(spark):
    codes = spark.createDataFrame(CODES, "code string, name string")
    by_name = {r.code5 for r in regions.leaf_regions(codes).collect()}
    by_prefix = {r.code5 for r in regions.leaf_regions(codes, "prefix").collect()}
    assert by_name == {"43111", "43112", "43740", "43745", "11110"}
    assert by_name - by_prefix == {"43740"}


WIDE = [
    ("No", "지역", "지역", "지역", "지수", "지수", "지수"),
    ("1", "충북", "청주시", "상당구", "200", "", "1,201.5"),
    ("2", "충북", "청주시", "청주시", "100", "", "101"),
    ("3", "충북", "영동군", "영동군", "", "50", ""),
    ("4", "충북", "괴산군", "괴산군", "", "", ""),
]


def wide(spark):
    return spark.createDataFrame(WIDE, ["No", "지역", "지역.1", "지역.2", "2021년 5월", "2021년 6월", "2021년 7월"])


def test_index_has_one_row_per_region_and_month(spark):
    index = land_index.one_per_month(land_index.wide_to_long(wide(spark)))
    got = {(r.land_region, r.dealMonth): r.land_index for r in index.collect()}
    assert got == {("청주시", 5): 100.0, ("청주시", 7): 101.0, ("영동군", 6): 50.0}


def test_index_gaps_are_filled_inside_the_region_only(spark):
    index = land_index.one_per_month(land_index.wide_to_long(wide(spark)))
    asked = [("청주시", 2021, 6), ("청주시", 2024, 1), ("청주시", 2019, 1), ("영동군", 2021, 5), ("괴산군", 2021, 6), (None, 2021, 6)]
    trades = spark.createDataFrame(asked, "land_region string, dealYear int, dealMonth int").withColumn("sido", F.lit("충북"))
    rows = land_index.attach_index(trades, index).collect()
    got = {(r.land_region, r.dealYear, r.dealMonth): (r.land_index, r.current_land_index) for r in rows}
    assert len(rows) == len(asked)
    assert got["청주시", 2021, 6] == (100.0, 101.0)
    assert got["청주시", 2024, 1] == (101.0, 101.0)
    assert got["청주시", 2019, 1] == (100.0, 101.0)
    assert got["영동군", 2021, 5] == (50.0, 50.0)
    assert got["괴산군", 2021, 6] == (None, None)
    # The grid over index and trade months gives the same values.
    grid = land_index.fill_months(land_index.month_grid(index, trades)).collect()
    for r in grid:
        key = (r.land_region, r.dealYear, r.dealMonth)
        if key in got:
            assert r.land_index == got[key][0]


def test_single_region_file_gets_the_label(spark):
    df = spark.createDataFrame([("1", "세종", "99")], ["No", "지역", "2021년 5월"])
    assert land_index.wide_to_long(df).first().land_region == "세종특별자치시"


def test_newest_answer_wins_and_errors_blank(spark):
    answers = spark.createDataFrame(
        [("a", 1, 1.0, None), ("a", 2, 2.0, None), ("b", 1, 3.0, None), ("b", 2, 4.0, "ADDRESS_NOT_FOUND")],
        "k string, seq int, lat double, error string",
    ).withColumns({"lng": F.lit(1.0), "subway_name": F.lit("s"), "subway_dist": F.lit(1.0)})
    trades = spark.createDataFrame([("a", 9.0), ("b", 9.0), ("c", 9.0), (None, 9.0)], "k string, lat double")
    got = {r.k: r.lat for r in lookups.merge_geocodes(trades, answers, ["seq"], ["k"]).collect()}
    assert got == {"a": 2.0, "b": None, "c": None, None: None}


def test_retryable_errors(spark):
    codes = ["ADDRESS_NOT_FOUND", "EXCEPTION_PARSE: x", "MAX_RETRIES_EXCEEDED", "API_FORBIDDEN_403", "EXCEPTION_CONN: y", None]
    df = spark.createDataFrame([(c,) for c in codes], "error string")
    assert [r.error for r in lookups.purge_retryable(df).collect()] == [codes[0], codes[1], None]


def test_approval_date(spark):
    rows = [("2001", "1999"), ("199", "2003"), (None, None), ("", "x")]
    df = spark.createDataFrame(rows, "approval_date string, buildYear string")
    got = [r.approval_date for r in lookups.approval_date_fallback(df).collect()]
    assert got == ["2001", "20030101", "20100101", "20100101"]


def _metres(a, b):
    (la, lo), (ma, mo) = (tuple(map(math.radians, p)) for p in (a, b))
    h = math.sin((ma - la) / 2) ** 2 + math.cos(la) * math.cos(ma) * math.sin((mo - lo) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("world", ["country", "globe", "crowd"])
def test_nearest_station_plans_agree_with_brute_force(spark, world):
    rng = random.Random(7)
    spot = {
        "country": lambda: (rng.uniform(33, 38), rng.uniform(126, 130)),
        "globe": lambda: (rng.uniform(-89, 89), rng.uniform(-180, 180)),
        # Most stations in one block, and two in one place.
        "crowd": lambda: (37.5 + rng.gauss(0, 1e-3), 127 + rng.gauss(0, 1e-3)),
    }[world]
    stations = [(f"s{i:03}", *spot()) for i in range(120)] + [("t0", 10.0, 10.0), ("t1", 10.0, 10.0), ("far", -60.0, -179.9)]
    points = [spot() for _ in range(150)] + [(10.0, 10.1), (0.0, 0.0), (-60.0, 179.9), (89.9, 5.0), stations[0][1:]]
    p = spark.createDataFrame([(i, *c) for i, c in enumerate(points)] + [(999, None, None)], "i int, lat double, lng double")
    s = spark.createDataFrame(stations, "subway_name string, lat double, lng double")
    want = {i: min((_metres(c, t[1:]), t[0]) for t in stations) for i, c in enumerate(points)}
    for limit in (0, 1_000):
        rows = nearest.nearest_station(p, s, list_limit=limit).collect()
        got = {r.i: (r.nearest_name, r.nearest_m) for r in rows}
        assert len(rows) == len(points) + 1 and got.pop(999) == (None, None)
        for i, (m, name) in want.items():
            assert got[i][0] == name, (limit, i)
            assert got[i][1] == pytest.approx(m, abs=1e-3)


def test_fill_leaves_known_rows_alone(spark):
    rows = [(1, 37.0, 127.0, "a", 5.0), (2, 37.1, 127.1, None, None), (3, None, None, None, None), (4, 38.0, 128.0, "b", 9.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lng double, subway_name string, subway_dist double")
    got = {r.id: (r.subway_name, r.subway_source) for r in nearest.fill_nearest_station(df).collect()}
    assert got == {1: ("a", "service"), 2: ("a", "centroid"), 3: (None, None), 4: ("b", "service")}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    # A third of the rows share one value.
    x = np.concatenate([rng.normal(size=4_000), np.full(2_000, 0.25)])
    df = spark.createDataFrame([(float(v), None if v > 1 else float(v)) for v in x], "a double, b double")
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]
    got = {(r.column, r.prob): r.value for r in profile.exact_quantiles(df, ["a", "b"], probs).collect()}
    for p in probs:
        assert got["a", p] == pytest.approx(np.percentile(x, p * 100))
        assert got["b", p] == pytest.approx(np.percentile(x[x <= 1], p * 100))
    assert profile.exact_quantiles(df.where("a > 99"), ["a"], [0.5]).count() == 0


def test_exact_quantiles_of_a_million_close_values(spark):
    """All values share their first 30 bits and differ."""
    df = spark.range(1_000_000).select((1 + F.col("id") * F.lit(2.0**-45)).alias("x"))
    got = {r.prob: r.value for r in profile.exact_quantiles(df, ["x"], [0.02, 0.5, 0.98]).collect()}
    assert got == {p: np.percentile(1 + np.arange(1_000_000) * 2.0**-45, p * 100) for p in (0.02, 0.5, 0.98)}


def test_ordered_bits_order_like_the_values(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=300), 10.0 ** rng.uniform(-320, 308, 300), 2.0 ** np.arange(-1074, 1024, 7)])
    x = np.concatenate([x, -x, np.nextafter(x, 0), [0.0, -0.0, 5e-324, 1.7976931348623157e308, np.inf, -np.inf]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    rows = df.select("x", ordered_bits("x").alias("k")).select("x", "k", bits_value("k").alias("back")).collect()
    assert [r.k for r in rows[-2:]] == [None, None]
    assert all(r.back == r.x == value_of_bits(r.k) for r in rows[:-2])
    assert all(abs(r.k) == np.array(abs(r.x)).view(np.int64) for r in rows[:-2])


def test_group_medians_of_continuous_columns(spark):
    """A hot group with many values, groups of one and two rows, null keys and groups without values."""
    rng = np.random.default_rng(6)
    rows = [("hot", float(v), int(w)) for v, w in zip(rng.lognormal(0, 3, 8001), rng.integers(1900, 2030, 8001))]
    rows += [("two", 1.5, 7), ("two", -2.25, None), ("one", float("nan"), 3), (None, 4.0, 5), ("none", None, None)]
    rows += [(f"g{i % 50}", float(v), i % 7) for i, v in enumerate(rng.normal(size=500))]
    df = spark.createDataFrame(rows, "g string, x double, y int").repartition(4)
    got = {r.g: (r._median_x, r._median_y) for r in impute.group_medians(df, ["x", "y"], ["g"]).collect()}
    groups = {}
    for g, x, y in rows:
        if g is not None:
            groups.setdefault(g, ([], []))
            for held, v in zip(groups[g], (x, y)):
                held.extend([] if v is None or v != v else [v])
    want = {g: tuple(float(np.median(v)) if v else None for v in held) for g, held in groups.items() if any(held)}
    assert got == {g: pytest.approx(v) for g, v in want.items()}


@pytest.mark.parametrize("kind", ["date", "timestamp", "string"])
def test_chronological_split_takes_the_earliest(spark, kind):
    """A day with most rows, rows without a date, and a cut at any place."""
    days = [f"2020-{1 + i % 12:02d}-{1 + i % 28:02d}" if i % 3 else "2020-06-15" for i in range(500)]
    rows = [(i, None if i % 50 == 7 else d) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id long, d string").withColumn("d", F.col("d").cast(kind))
    for fraction in (0.0, 0.01, 0.3, 0.5, 0.8, 1.0):
        got = split.chronological_split(df, "d", "id", fraction).select("id", "split").collect()
        train = {r.id for r in got if r.split == "train"}
        assert len(got) == 500 and len(train) == int(500 * fraction)
        latest = max((rows[i][1] or "" for i in train), default="")
        assert all((rows[r.id][1] or "") >= latest for r in got if r.split == "test")


def test_column_profile(spark):
    df = spark.createDataFrame([(None, " ", 0), ("x", "", 1), ("y", None, None)], "a string, b string, dealAmount long")
    got = {r.column: (r.nulls, r.null_pct, r.blanks, r.zeros) for r in profile.column_profile(df).collect()}
    assert got == {"a": (1, 33.33, 0, 0), "b": (1, 33.33, 2, 0), "dealAmount": (1, 33.33, 0, 1)}


def test_completeness_and_conform(spark):
    df = spark.createDataFrame([("1", "1990", "2000"), ("x", None, "2001")], "floor string, buildYear string, dealYear string")
    rows, absent = filters.conform(df)
    assert [(r.floor, r.Age) for r in rows.collect()] == [(1.0, 10.0), (None, None)]
    assert "Age" not in absent and "lat" in absent
    row = profile.completeness(rows, ["floor", "nope"]).first()
    assert (row.floor_nulls, row.complete) == (1, False)


def test_median_fill_skips_null_groups(spark):
    rows = [("a", 1), ("a", 4), ("a", None), (None, None), (None, 100), ("b", None)]
    df = spark.createDataFrame(rows, "umdNm string, floor int")
    got = [(r.umdNm, r.floor) for r in impute.median_fill(df, ["floor"]).collect()]
    # Column after the group fill: 1, 4, 2.5, 100 -> median 3.25.
    assert sorted(got, key=repr) == sorted(
        [("a", 1.0), ("a", 4.0), ("a", 2.5), (None, 3.25), (None, 100.0), ("b", 3.25)], key=repr
    )


def test_parking_elevator_floors(spark):
    rows = [("a", 0.5, None, 2015, None, 3), ("a", None, "0", 2015, 7, 3), ("b", None, None, None, None, None)]
    df = spark.createDataFrame(
        rows, "umdNm string, parking_ratio double, has_elevator string, buildYear int, total_floors int, floor int"
    )
    out = impute.floors_fill(impute.elevator_fill(impute.parking_fill(df)))
    got = sorted((r.umdNm, r.parking_ratio, r.has_elevator, r.total_floors) for r in out.collect())
    assert got == [("a", 0.5, 0, 7), ("a", 0.5, 1, 3), ("b", 0.5, 0, 1)]


def test_label_codes_send_unseen_to_unknown(spark):
    train = spark.createDataFrame([("b",), ("가",), (None,), ("Z",)], "c string")
    enc = encode.LabelEncoder.fit(train, ["c"])
    df = spark.createDataFrame([("b",), ("new",), (None,), ("가",), ("Z",)], "c string")
    got = {r.c: r.c_encoded for r in enc.transform(df).collect()}
    # Sorted: UNKNOWN, Z, b, 가.
    assert got == {"Z": 1, "b": 2, "가": 3, "new": 0, None: 0}


def test_robust_scaler_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "x double, k double")
    rows = encode.RobustScaler.fit(df, ["x", "k"]).transform(df).collect()
    assert [r.x_scaled for r in rows] == [0.0, 1.0, -1.0] and {r.k_scaled for r in rows} == {0.0}


def test_one_hot_and_target_means(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0), (None, 9.0)], "c string, y double")
    assert encode.one_hot_levels(df, "c") == ["b"]
    assert sorted(r.c_b for r in encode.one_hot(df, "c", ["b"]).collect()) == [0, 0, 1, 1]
    enc = encode.target_encode(df, encode.target_means(df, "c", "y"), "c")
    assert {r.c: r.c_encoded for r in enc.collect()} == {"a": 1.0, "b": 3.0, None: None}
    with pytest.raises(ValueError):
        encode.one_hot_levels(df, "c", max_levels=1)


@pytest.mark.parametrize("n", [1, 7, 1_000])
def test_chronological_split_is_exact_on_a_hot_day(spark, n):
    # Nine of ten rows fall on one day, which holds the cut.
    df = spark.range(n).select("id", F.when(F.col("id") % 10 == 0, "2020-01-01").otherwise("2020-01-02").cast("date").alias("d"))
    rows = split.chronological_split(df, "d", "id").collect()
    train = [r for r in rows if r.split == "train"]
    assert len(train) == int(n * 0.8) and len(rows) == n
    if train and len(train) < n:
        assert max(r.d for r in train) <= min(r.d for r in rows if r.split == "test")


def test_hash_split_is_stable_and_complete(spark):
    ids = spark.range(5_000)
    first = {r.id: r.split for r in split.hash_split(ids, "id", 70, 10).collect()}
    again = {r.id: r.split for r in split.hash_split(ids.repartition(7), "id", 70, 10).collect()}
    assert first == again
    assert 0.65 < sum(v == "train" for v in first.values()) / 5_000 < 0.75


def test_metrics(spark):
    y = np.array([1.0, 2.0, 4.0, 8.0])
    p = np.array([1.5, 2.0, 3.0, 9.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.mae == pytest.approx(np.abs(y - p).mean())
    assert row.mape == pytest.approx((np.abs(y - p) / y).mean() * 100)
    bins = metrics.error_histogram(df, "y", "p", bins=5).collect()
    want, _ = np.histogram(np.abs(y - p) / y * 100, bins=5)
    assert [r.rows for r in sorted(bins, key=lambda r: r.bin)] == list(want)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<float>")


def test_comparables_exclude_self_by_id(spark):
    # Rows 0 and 1 are the same vector; row 3 has no length.
    df = _vectors(spark, [[1, 0], [1, 0], [0.6, 0.8], [0, 0]])
    assert [(r.id, round(r.similarity, 6)) for r in similar.comparables(df, 1, 3).collect()] == [(0, 1.0), (2, 0.6), (3, 0.0)]
    assert similar.comparables(df, 77, 3).count() == 0


def _best_of_all(m, ids, n):
    """Plain top n per row, as (query, rank, id, similarity to six digits)."""
    unit = m.astype(float)
    length = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit / np.where(length == 0, 1, length)
    want = set()
    for q in range(len(m)):
        sims = (unit * unit[q]).sum(axis=1)
        best = sorted((-sims[c], ids[c]) for c in range(len(m)) if c != q)[:n]
        want |= {(ids[q], r + 1, i, round(-s, 6)) for r, (s, i) in enumerate(best)}
    return want


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("kwargs", [{}, {"block_rows": 17}, {"block_rows": 5, "max_pivots": 3}])
def test_batch_comparables_equal_brute_force(spark, kind, kwargs):
    rng = np.random.default_rng(5)
    m = np.concatenate([rng.normal(size=(90, 6)), 5 + rng.normal(size=(60, 6))]).astype(np.float32)
    m[40:80] = m[40]  # Many rows are copies of one.
    m[100:103] = 0
    ids = list(range(150)) if kind == "long" else [f"é{i}" for i in range(150)]
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, m)]
    extra = [(999 if kind == "long" else "x", None), (998 if kind == "long" else "y", [float("nan")] * 6)]
    df = spark.createDataFrame(rows + extra, f"id {kind}, embedding array<float>")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = similar.batch_comparables(df.repartition(5), df, **kwargs).collect()
    finally:
        spark.conf.unset(coalesce)
    assert {(r.query_id, r.rank, r.id, round(r.similarity, 6)) for r in got} == _best_of_all(m, ids, 3)


def test_batch_comparables_skip_far_blocks(spark):
    """Clustered rows: few of all pairs of query and block are compared, and the rest is not missed."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    m = (centres[rng.integers(0, 30, 3000)] + rng.normal(0, 0.02, (3000, 16))).astype(np.float32)
    df = _vectors(spark, m)
    search = similar.BlockSearch(df, n=3, block_rows=60)
    found, report = search.answer(df)
    work = report.first()
    assert work.queries == 3000 and work.blocks >= 50 and work.pairs == 3000 * work.blocks
    assert work.compared < work.pairs / 5
    assert {(r.query_id, r.rank, r.id, round(r.similarity, 6)) for r in found.collect()} == _best_of_all(m, list(range(3000)), 3)


def test_batch_comparables_of_nothing(spark):
    none, one = _vectors(spark, []), _vectors(spark, [[1.0, 2.0]])
    assert similar.batch_comparables(one, none).collect() == []
    assert similar.batch_comparables(none, one).collect() == []
    assert similar.batch_comparables(one, one).collect() == []


def test_latent_space_matches_a_dense_decomposition(spark):
    words = ["apple pear", "pear plum", "plum apple", "fig", "fig kiwi", "kiwi apple pear", "plum fig kiwi", "pear pear fig"]
    rng = random.Random(1)
    texts = spark.createDataFrame([(i, " ".join(rng.choices(words, k=4))) for i in range(40)], "id long, t string")
    weights = lsa.TermWeights.fit(texts, "t", max_terms=20)
    assert len(weights.terms) == 20
    weighted = weights.transform(texts, "t").persist()
    dense = np.array([r.weights.toArray() for r in weighted.orderBy("id").collect()])
    assert np.allclose(np.linalg.norm(dense, axis=1), 1)
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    want = u[:, :5] * s[:5]
    got = lsa.LatentSpace.fit(weighted, 5).transform(weighted, "id").orderBy("id").collect()
    got = np.array([r.embedding for r in got])
    # Signs are free, so inner products are compared.
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-4)
    long = weights.entries(texts, "id", "t").collect()
    assert {(r.id, r.idx): round(r.weight, 9) for r in long} == {
        (i, j): round(dense[i, j], 9) for i, j in zip(*np.nonzero(dense))
    }


def test_latent_space_reads_the_rows_a_fixed_number_of_times(spark, monkeypatch):
    rng = np.random.default_rng(2)
    dense = rng.normal(size=(200, 40)) * (rng.random((200, 40)) < 0.2)
    rows = [(i, Vectors.sparse(40, [(int(j), float(v[j])) for j in np.flatnonzero(v)])) for i, v in enumerate(dense)]
    weighted = spark.createDataFrame(rows, ["id", "weights"]).repartition(20, "id")  # merged in more than one round
    read, real = [], lsa._gathered
    monkeypatch.setattr(lsa, "_gathered", lambda *a: read.append(a[3]) or real(*a))
    space = lsa.LatentSpace.fit(weighted, 10, spare=30, passes=6)
    assert read == ["sum"] * 5 + ["triangle"]
    assert np.allclose(space.singular_values, np.linalg.svd(dense)[1][:10])
    assert lsa.LatentSpace.fit(weighted.limit(0), 10).components.shape == (0, 0)


def test_model_beats_the_mean_and_keeps_missing_rows(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        a, b = rng.uniform(0, 10), rng.uniform(0, 1)
        rows.append((i, None if i % 10 == 0 else float(a), float(b), float(np.log1p(100 + 50 * a + 20 * b))))
    df = split.hash_split(spark.createDataFrame(rows, "id long, a double, b double, y double"), "id", 60, 20)
    fitted = model.fit_advanced(df, ["a", "b"], "y", trees=30, leaves=8, rate=0.3)
    test = df.where("split = 'test'")
    scored = model.predict(fitted, test)
    assert scored.count() == test.count() and scored.where("a is null").count() > 0
    scored = scored.withColumn("actual", F.expm1("y"))
    assert metrics.regression_metrics(scored.where("a is not null"), "actual", "predicted_price").first().r2 > 0.8
    importances = {r.feature: r.importance for r in model.feature_importances(fitted, spark).collect()}
    assert importances["a"] > importances["b"]


def test_valuation_serves_as_it_trained(spark, tmp_path):
    from landgauge.constants import TARGET
    from landgauge.plans.valuation import Valuation

    rows = [
        (f"r{i}", "연립다세대" if i % 3 else "단독", f"dong{i % 4}", 30.0 + i % 40, 20.0 + i % 7, i % 5, 1990 + i % 30, i % 30,
         None if i % 6 == 0 else 0.3 + i % 4, None if i % 5 == 0 else i % 2, None if i % 7 == 0 else 4, 400.0 * (i % 9), 90.0 + i % 9, 14.0 + (i % 40) / 50)
        for i in range(300)
    ]
    names = "row_id houseType umdNm excluUseAr landAr floor buildYear Age parking_ratio has_elevator total_floors subway_dist land_index"
    target = spark.createDataFrame(rows, [*names.split(), TARGET])
    fitted, _ = Valuation.fit(target, "row_id", trees=3, leaves=8, rate=0.3)
    raw = target.drop(TARGET)
    first = {r["row_id"]: r["estimated_value"] for r in fitted.value(raw).collect()}
    # One property alone meets the same fill values as among all others.
    alone = fitted.value(raw.where("row_id = 'r0'")).first()
    assert alone["estimated_value"] == first["r0"] and alone["houseType_연립"] == 0
    assert fitted.value(raw.where("row_id = 'r1'")).first()["houseType_연립"] == 1
    fitted.save(str(tmp_path / "valuation"))
    again = Valuation.load(spark, str(tmp_path / "valuation"))
    assert {r["row_id"]: r["estimated_value"] for r in again.value(raw).collect()} == first
