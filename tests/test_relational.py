import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates, maths, strings
from tidemill.operators import joins as J
from tidemill.operators import loads as U
from tidemill.operators import relational as P


def test_merge_indicator_matches_null_keys(spark, rows):
    l = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a int")
    r = spark.createDataFrame([(2,), (3,), (None,)], "b int")
    got = rows(J.merge_indicator(l, r, [("a", "b")]))
    assert got == [(None, None, "both"), (None, 3, "right_only"), (1, None, "left_only"), (2, 2, "both"), (2, 2, "both")]


def test_upsert_modes(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k int, v string")
    assert rows(U.upsert(target, source, ["k"])) == [(1, "a"), (2, "b"), (3, "y")]
    once = U.upsert(target, source, ["k"], "replace", [F.desc("v")])
    assert rows(once) == [(1, "a"), (2, "x"), (3, "z")]
    assert rows(U.upsert(once, source, ["k"], "replace", [F.desc("v")])) == rows(once)
    with pytest.raises(ValueError):
        U.upsert(target, source, ["k"], "other")


def test_only_new_and_enrich(spark, rows):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2, "x")], "k2 int, name string")
    assert rows(J.only_new(a, b.withColumnRenamed("k2", "k"), ["k"])) == [(1,)]
    df, counts = J.enrich(a, [(b, [("k", "k2")], "name")])
    assert rows(counts) == [("name", 1)] and df.count() == 2


def test_join_rounded_and_lookup(spark, rows):
    l = spark.createDataFrame([("t", 218.93179)], "title string, len double")
    r = spark.createDataFrame([("t", 219.2)], "name string, dur double")
    assert J.join_rounded(l, r, [("title", "name")], ("len", "dur"), None, "inner").count() == 0
    assert J.join_rounded(l, r, [("title", "name")], ("len", "dur"), 0, "inner").count() == 1
    got = J.lookup(l, "title", r.select(F.lit("q").alias("id"), "dur"), "id", "dur", 0.0, "d")
    assert rows(got, "d") == [(0.0,)]


@pytest.mark.parametrize("light", [J.LIGHT, 2, 0])
def test_common_neighbours_with_hub(spark, rows, monkeypatch, light):
    monkeypatch.setattr(J, "LIGHT", light)
    hub = [("h", f"n{i}") for i in range(40)]
    edges = spark.createDataFrame(hub + [("a", "n1"), ("a", "n2"), ("a", "z")], "src string, dst string")
    pairs = spark.createDataFrame([("h", "a"), ("a", "h"), ("h", "x"), ("n1", "n2")], "a string, b string")
    assert rows(J.common_neighbours(edges, pairs)) == [("a", "h", 2), ("h", "a", 2), ("h", "x", 0), ("n1", "n2", 2)]


def test_common_neighbours_works_edges_out_once(spark, rows):
    """Edges and pairs are read from written copies, however many steps need them."""
    edges = spark.createDataFrame([("a", "n"), ("b", "n"), ("b", "m")], "src string, dst string")
    got = J.common_neighbours(edges, spark.createDataFrame([("a", "b"), ("a", "m")], "a string, b string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "Union" not in plan
    assert rows(got) == [("a", "b", 1), ("a", "m", 0)]


def test_block_grid(spark, rows):
    df = spark.createDataFrame([(1, "s", "i", 2), (1, "t", "j", 3)], "m int, a string, b string, v int")
    assert rows(J.block_grid(df, "m", "a", "b", F.sum("v"), "n")) == [(1, "s", "i", 2), (1, "s", "j", 0), (1, "t", "i", 0), (1, "t", "j", 3)]


def test_filters(spark, rows):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None)], "c string, v double")
    assert rows(P.keep_codes(df, "c", exclude=["a"]), "c") == [("b",)]
    assert rows(P.clip(df, "v", 1.5, 1.8), "v") == [(None,), (1.5,), (1.8,)]
    assert rows(P.bucket(df, "v", [0, 1.5, 9], ["low", "high"], "b"), "b") == [(None,), ("high",), ("low",)]
    assert P.safe_names(df.toDF("Foreign-born", "Total Population")).columns == ["Foreign_born", "Total_Population"]
    assert P.sample_hash(spark.range(100), "id", 7).collect() == P.sample_hash(spark.range(100).repartition(5), "id", 7).collect()


def test_season_of_every_month_and_null(spark):
    df = spark.createDataFrame([(m,) for m in [*range(1, 13), None]], "m int")
    got = [r[0] for r in df.select(dates.season(F.col("m"))).collect()]
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter", None]


def test_time_functions(spark, rows):
    df = spark.createDataFrame([("1541106106796", "1.54111E+12", 20550.0)], "a string, b string, s double")
    got = df.select(dates.epoch_ms(F.col("a")), dates.epoch_ms(F.col("b")), dates.sas_date(F.col("s"))).first()
    assert got[0] == dt.datetime(2018, 11, 1, 21, 1, 46, 796000)
    assert got[1] == dt.datetime(2018, 11, 1, 22, 6, 40)
    assert got[2] == dt.date(2016, 4, 6)


def test_two_plays_in_one_second_share_a_key(spark):
    df = spark.createDataFrame([(1, 1541106106100), (1, 1541106106900)], "s int, ts bigint")
    keys = df.select(dates.play_key(F.col("s"), dates.epoch_ms(F.col("ts"))).alias("k")).distinct()
    assert keys.count() == 1


def test_date_swap_and_iso_monday(spark, rows):
    df = spark.createDataFrame([("2018-05-03", "2018-03-20"), ("2018-03-03", "2018-03-20"), ("2018-05-20", "2018-03-20")], "t string, s string")
    got = df.select(dates.swap_day_month(F.col("t").cast("date"), F.col("s").cast("date")).cast("string").alias("d"))
    assert [r.d for r in got.collect()] == ["2018-03-05", "2018-03-03", "2018-05-20"]
    monday = spark.range(1).select(dates.iso_monday(F.lit(2015), F.lit(1)).cast("string")).first()[0]
    assert monday == "2014-12-29"


def test_strings(spark):
    df = spark.createDataFrame([("a#39;b  c &lt;x&gt; @-@ d",)], "t string")
    assert df.select(strings.fixup(F.col("t"))).first()[0] == "a'b c <x>-d"
    q = spark.createDataFrame([("What now? Yes",), ("No.",)], "t string").select(strings.question(F.col("t"), "en"))
    assert [r[0] for r in q.collect()] == ["What now?", None]
    assert spark.range(1).select(strings.marked(F.lit("x"), F.lit("y"))).first()[0] == "\nxbos xfld 1 x xfld 2 y"


def test_maths(spark):
    r = spark.range(1).select(maths.softmax(F.array(F.lit(1000.0), F.lit(1000.0))).alias("s"), maths.sigmoid(F.lit(0.0)).alias("g")).first()
    assert r["s"] == [0.5, 0.5] and r["g"] == 0.5


def test_unescape(spark):
    import html

    texts = [
        "a&amp;lt;b &lt;x&gt; &#65;&#x42;&#X1F600; &#128; &#x97; &#0; &#xD800; &#99999999999; &#1114112; &unknown; &NotEqualTilde; & &; &&amp; end&middot;\n&copy;\nz",
        "no refs", None, "", "&eacute;&#233;", "&hellip;x&",
        # The old names and numbers without a semicolon, the longest of several, names that begin with an old one, no characters.
        "&copy 1 &amp&lt2 &notit; &not; &notin; &ampamp; &AMPx &#65B &#x41g &#x; &#; &hellip x", "&#1;&#11;&#127;a&#xFDD0;&#xFFFE;&#x1FFFF&#13;b",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(strings.unescape(F.col("t"))).collect()]
    assert got == [t if t is None else html.unescape(t) for t in texts]
