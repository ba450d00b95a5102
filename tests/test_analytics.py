import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.operators import windows as W


def _days(spark, flags):
    start = dt.date(2020, 1, 1)
    return spark.createDataFrame([("s", start + dt.timedelta(i), f) for i, f in enumerate(flags)], "k string, d date, f int")


def test_days_since_and_until(spark, rows):
    df = _days(spark, [0, 1, 0, 0, 1, 0])
    got = W.days_until(W.days_since(df, "k", "d", ["f"]), "k", "d", ["f"]).orderBy("d").collect()
    assert [r["Afterf"] for r in got] == [0, 0, 1, 2, 0, 1]
    assert [r["Beforef"] for r in got] == [-1, 0, -2, -1, 0, 0]


def test_rolling(spark):
    got = W.rolling(_days(spark, [1] * 10), "k", "d", ["f"]).orderBy("d").collect()
    assert [r["f_bw"] for r in got] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 7]
    assert [r["f_fw"] for r in got] == [7, 7, 7, 7, 6, 5, 4, 3, 2, 1]


def test_encodings_of_one_item(spark):
    df = spark.createDataFrame([("i", 0, 0.0), ("i", 1, 1.0), ("i", 2, 1.0)], "k string, o int, y double")

    def enc(scheme, **kw):
        return [r["enc"] for r in W.target_encode(df, "k", "y", scheme, [F.col("o")], **kw).orderBy("o").collect()]

    assert enc("mean") == pytest.approx([2 / 3] * 3)
    assert enc("loo") == [1.0, 0.5, 0.5]
    assert enc("expanding") == [0.3343, 0.0, 0.5]
    assert enc("smooth", alpha=3.0) == pytest.approx([(2 + 2 / 3 * 3) / 6] * 3)
    assert enc("kfold", k=3) == [1.0, 0.5, 0.5]
    with pytest.raises(ValueError):
        enc("other")


def test_kfold_against_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("aab"), i, float(rnd.randint(0, 9))) for i in range(23)]
    df = spark.createDataFrame(data, "k string, o int, y double").repartition(5)
    got = {r["o"]: r["enc"] for r in W.target_encode(df, "k", "y", "kfold", [F.col("o")], k=5).collect()}
    sizes, fold, at = [5, 5, 5, 4, 4], {}, 0
    for f, n in enumerate(sizes):
        for _ in range(n):
            fold[at] = f
            at += 1
    for k, o, _ in data:
        other = [y for k2, o2, y in data if k2 == k and fold[o2] != fold[o]]
        assert got[o] == pytest.approx(sum(other) / len(other) if other else 0.3343)


def test_missing_dates_and_windows(spark, rows):
    days = spark.createDataFrame([(dt.date(2020, 1, d),) for d in (1, 2, 5)], "d date")
    assert rows(W.missing_dates(days, "d")) == [(dt.date(2020, 1, 3),), (dt.date(2020, 1, 4),)]
    text = spark.createDataFrame([(1, "abcdefgh"), (2, "ab")], "id int, t string")
    assert rows(W.char_windows(text, "id", "t", 3, 3)) == [(1, 0, "abc", "d"), (1, 3, "def", "g")]


def test_best_split_against_brute_force(spark):
    rnd = random.Random(5)
    pts = [(rnd.randint(0, 12), rnd.random() + (4 if i % 3 else 0)) for i in range(60)]

    def dev(v):
        m = sum(v) / len(v)
        return math.sqrt(max(sum(x * x for x in v) / len(v) - m * m, 0)) * len(v)

    best = None
    for s in sorted({x for x, _ in pts}):
        l, r = [y for x, y in pts if x <= s], [y for x, y in pts if x > s]
        if len(l) >= 4 and len(r) >= 4 and (best is None or dev(l) + dev(r) < best[1] - 1e-9):
            best = (s, dev(l) + dev(r))
    got = W.best_split(spark.createDataFrame(pts, "x int, y double"), "x", "y", 4).first()
    assert got["split"] == best[0] and got["score"] == pytest.approx(best[1])


def test_dup_flag_time_split_folds(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, t int")
    assert rows(W.dup_flag(df, ["k"]), "t", "is_dup") == [(1, True), (2, True), (3, False)]
    assert rows(W.time_split(df, [F.col("t")], n=1), "t", "is_valid") == [(1, False), (2, False), (3, True)]
    folds = W.time_folds(spark.range(25), [F.col("id")], 10).groupBy("block").count()
    assert dict(folds.collect())[0] == 5 and folds.count() == 11


def test_pr_curve(spark, rows):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0)], "s double, y int")
    curve = W.pr_curve(df, "s", "y")
    assert rows(curve, "threshold", "precision", "recall") == [(0.7, 0.5, 1.0), (0.8, 0.5, 0.5), (0.9, 1.0, 0.5)]
    assert W.average_precision(curve).first()[0] == 0.75
    assert W.recall_at_precision(curve, 0.6).first()[0] == 0.5


def test_weighted_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert A.weighted_median(df, "x").first()[0] == 1.0


def test_percentiles_and_profile(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 40.0)], "a int, b double")
    p = {r["column"]: r for r in A.profile(df).collect()}
    assert (p["a"]["count"], p["a"]["q25"], p["a"]["q50"], p["a"]["q75"], p["a"]["uniques"]) == (4, 1.75, 2.5, 3.25, 4)
    assert (p["b"]["count"], p["b"]["missing"], p["b"]["q50"], p["b"]["min"]) == (3, 1, 30.0, 10.0)
    assert p["a"]["std"] == pytest.approx(1.2909944)


def test_list_agg_continues_in_parts(spark, rows):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, v int")
    assert rows(A.list_agg(df, ["k"], "v", ["v"])) == [("a", "0,1,2,3,4"), ("b", "9")]


def test_margins_constant_coverage(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "a string, b int")
    assert ("All", "All", 3) in rows(A.margins(df, "a", "b"))
    assert rows(A.constant_groups(df, "a", "b")) == [("y",)]
    tokens = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "token string")
    assert A.coverage(tokens, tokens.where("token = 'a'")).first()[0] == 0.5


def test_spearman_with_ties(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, 9), (3, 5), (1, 1)], "a int, b int")
    ranks_a, ranks_b = [1.5, 3, 4.5, 4.5, 1.5], [2.5, 2.5, 5, 4, 1]
    ma, mb = 3, 3
    cov = sum((x - ma) * (y - mb) for x, y in zip(ranks_a, ranks_b))
    want = cov / math.sqrt(sum((x - ma) ** 2 for x in ranks_a) * sum((y - mb) ** 2 for y in ranks_b))
    assert A.spearman(df, ["a", "b"]).first()["rho"] == pytest.approx(want)


def test_whole_numbers_keep_apart(spark, rows):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**53 + 2,), (None,)], "k long")
    assert A.value_counts(df, ["k"]).count() == 4
    assert A.profile(df).first()["uniques"] == 3


def test_profile_of_all_types(spark, rows):
    import datetime
    from decimal import Decimal

    day = datetime.date(2024, 1, 2)
    data = [(1, 0.5, Decimal("1.10"), "b", day, True), (2, None, Decimal("1.10"), "a", day, None), (3, 1.5, None, None, None, None)]
    got = {r["column"]: r for r in A.profile(spark.createDataFrame(data, "i int, d double, m decimal(10,2), s string, t date, b boolean")).collect()}
    assert (got["i"]["mean"], got["i"]["uniques"], got["i"]["q50"], got["i"]["top"]) == (2.0, 3, 2.0, None)
    assert (got["d"]["count"], got["d"]["missing"], got["m"]["uniques"], got["m"]["mean"]) == (2, 1, 1, 1.1)
    assert (got["s"]["top"], got["s"]["freq"], got["s"]["uniques"], got["s"]["mean"]) == ("a", 1, 2, None)
    assert (got["t"]["top"], got["t"]["freq"], got["b"]["top"], got["b"]["missing"]) == ("2024-01-02", 2, "true", 2)


def test_pivot_finds_its_values(spark, rows):
    df = spark.createDataFrame([("x", "new", 1), ("x", "odd", 2), ("y", "odd", 3)], "r string, c string, v int")
    assert rows(A.pivot_count(df, F.col("r"), "c"), "r", "new", "odd") == [("x", 1, 1), ("y", 0, 1)]
    assert rows(A.pivot_sum(df, "r", "c", F.col("v")), "r", "odd") == [("x", 2), ("y", 3)]
