"""Skew-safe blocks against brute force, with the hot path forced."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import scale


def test_attach_hot_and_cold_keys(spark, rows):
    data = [("hot", i) for i in range(50)] + [("cold", i) for i in range(3)] + [(None, 1), (None, 2), ("alone", 9)]
    df = spark.createDataFrame(data, "k string, v int")
    stats = df.where("k <> 'alone'").groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    got = rows(scale.attach(df, stats, ["k"], "n", hot_rows=10))
    sums = {"hot": (50, 1225), "cold": (3, 3)}
    want = [(k, v, *sums.get(k, (None, None))) for k, v in data]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_attach_spreads_identical_rows_of_a_hot_key(spark):
    df = spark.range(4000, numPartitions=40).select(F.lit("hot").alias("k"))
    stats = df.groupBy("k").agg(F.count("*").alias("n"))
    plan = scale.attach(df, stats, ["k"], "n", hot_rows=10)
    assert plan.where("n = 4000").count() == 4000
    spread = F.pmod(F.xxhash64(F.col("k"), F.spark_partition_id()), F.lit(scale.SALTS))
    assert df.select(spread).distinct().count() > 30


def test_attach_two_keys(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("a", 2, 7)], "k string, j int, v int")
    got = scale.with_group_stats(df, ["k", "j"], hot_rows=1, s=F.sum("v"))
    assert rows(got) == [("a", 1, 5, 11), ("a", 1, 6, 11), ("a", 2, 7, 7)]


def test_ordered_scan_matches_running_sum(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.randint(0, 99), i, rnd.randint(-5, 5)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o int, i int, v int").repartition(7)
    for keys in ([], ["k"]):
        got = scale.ordered_scan(df, [F.col("o"), F.col("i")], {"run": F.col("v"), "rn": F.lit(1)}, keys, parts=5)
        seen, want = {}, {}
        for k, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
            g = k if keys else 0
            s, n = seen.get(g, (0, 0))
            seen[g] = (s + v, n + 1)
            want[i] = seen[g]
        assert {r["i"]: (r["run"], r["rn"]) for r in got.collect()} == want


def test_ordered_scan_empty_and_null_values(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "o int, v double")
    assert rows(scale.ordered_scan(df, [F.col("o")], {"s": F.col("v")}, parts=2)) == [(1, None, None), (2, 3.0, 3.0)]
    assert scale.ordered_scan(df.limit(0), [F.col("o")], {"s": F.col("v")}).count() == 0


def test_top_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = scale.top_per_key(df, ["k"], [F.desc("id")], 2)
    assert {tuple(r) for r in top.collect()} == {(0, 999), (0, 996), (1, 997), (1, 994), (2, 998), (2, 995)}
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_literal_rows(spark, rows):
    assert rows(scale.literal_rows(spark, [(1, "a"), (2, "b")], "id bigint, t string")) == [(1, "a"), (2, "b")]
    assert scale.literal_rows(spark, [], "id bigint, t string").count() == 0


@pytest.mark.parametrize("kinds", [("long", "int"), ("int", "long"), ("decimal(10,2)", "decimal(12,4)"), ("double", "float"), ("int", "double")])
def test_attach_compares_values_not_types(spark, rows, kinds):
    df = spark.range(20).select((F.col("id") % 5).cast(kinds[0]).alias("k"), F.col("id").alias("v"))
    stats = spark.range(5).select(F.col("id").cast(kinds[1]).alias("k"), F.lit(4).alias("n"), (F.col("id") * 10).alias("s"))
    for hot in (1, 10):
        got = rows(scale.attach(df, stats, ["k"], "n", hot_rows=hot), "v", "s")
        assert got == [(v, v % 5 * 10) for v in range(20)]


def test_attach_one_zero(spark, rows):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, v int")
    stats = spark.createDataFrame([(0.0, 1, "x")], "k double, n int, s string")
    assert rows(scale.attach(df, stats, ["k"], "n"), "v", "s") == [(1, "x"), (2, "x")]


def test_number_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(scale, "RANGE_LEAST", 10)
    monkeypatch.setattr(scale, "RANGE_MOST", 100)
    assert [scale.ranges_for(spark.range(n)) for n in (0, 25, 350, 1000)] == [1, 3, 4, 10]


def test_written_copies_go(spark):
    """A copy that is discarded leaves no folder; a scan keeps only what its result reads."""
    import os

    from tidemill import session

    folder = session.checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    copy = session.materialise(spark.range(10))
    assert len(set(os.listdir(folder)) - before) == 1
    session.discard(copy)
    session.discard(copy)  # a second time does nothing
    assert set(os.listdir(folder)) == before
    run = scale.ordered_scan(spark.range(100), [F.col("id")], {"n": F.lit(1).cast("long")})
    assert run.count() == 100 and len(set(os.listdir(folder)) - before) == 1
