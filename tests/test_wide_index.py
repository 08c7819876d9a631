"""The wide index covers all months of the orders."""

from pyspark.sql import functions as F

from landgauge.catalog import tables


def test_months_outside_of_1995_to_2001_stay(spark, monkeypatch):
    sf, plain = "/root/testdata/sf0.001", tables.table
    before = tables.wide_index(spark, sf)
    later = lambda df: df.withColumn("o_orderdate", F.add_months("o_orderdate", 240))
    monkeypatch.setattr(tables, "table", lambda s, d, name: later(plain(s, d, name)) if name == "orders" else plain(s, d, name))
    after = tables.wide_index(spark, sf)
    months = lambda df: [c for c in df.columns if "년" in c]
    filled = lambda df: df.select(*[F.count(f"`{c}`") for c in months(df)]).first()
    assert [int(c[:4]) + 20 for c in months(before)] == [int(c[:4]) for c in months(after)]
    assert sum(filled(before)) == sum(filled(after)) > 0
