"""What steps leave on the disk and hold in a task, on rows of the tests' own."""

import random
import re

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.operators import approximate as X
from tidemill.operators import boxes as B
from tidemill.operators import joins as J
from tidemill.operators import modelling as M
from tidemill.operators import nearest as N
from tidemill.plans import star


def shuffles(spark):
    """Shuffles whose files are on the disk."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def test_factorisation_drops_its_shuffles(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(u, i, float(rnd.randint(1, 50))) for u in range(30) for i in range(20) if rnd.random() < 0.5], "u int, i int, r float")
    before = shuffles(spark)
    model = M.fit_als(df, "u", "i", "r", rank=3, iterations=9)
    assert shuffles(spark) - before < 9
    assert model.userFactors.count() == 30


def test_blocks_of_a_factorisation_follow_the_ratings(spark, monkeypatch):
    """Before, there were ten blocks however many ratings there were, so that a task held a tenth of them."""
    seen = []
    real = M.ALS
    monkeypatch.setattr(M, "ALS", lambda **kw: seen.append((kw.get("numUserBlocks"), kw.get("numItemBlocks"))) or real(**kw))
    df = spark.range(400).selectExpr("cast(id % 20 as int) u", "cast(id % 33 as int) i", "cast(id % 5 as float) r")
    M.fit_als(df, "u", "i", "r", rank=2, iterations=1)
    monkeypatch.setattr(M, "ALS_RATINGS", 25, raising=False)
    model = M.fit_als(df, "u", "i", "r", rank=2, iterations=1)
    assert seen == [(10, 10), (16, 16)] and model.userFactors.count() == 20


def test_grid_is_not_shuffled(spark, rows, monkeypatch):
    """Nulls in every key, sums of null and NaN, and more keys than travel together."""
    monkeypatch.setattr(J, "GRID_SLOT", 4)
    data = [(m, f"s{s}", f"i{i}", float(s + i)) for m in (1, 2) for s in range(6) for i in range(9) if (s * i + m) % 4 == 0]
    data += [(None, "s1", "i1", 5.0), (1, None, "i1", 6.0), (1, "s1", None, 7.0), (2, "s0", "i77", None), (2, "s1", "i78", float("nan"))]
    df = spark.createDataFrame(data, "m int, a string, b string, v double")
    got = J.block_grid(df, "m", "a", "b", F.sum("v"), "n")
    sums = df.groupBy("m", "a", "b").agg(F.sum("v").alias("n"))
    grid = sums.select("m", "a").distinct().join(sums.select("m", "b").distinct(), "m")
    assert rows(got) == rows(grid.join(sums, ["m", "a", "b"], "left").fillna(0, ["n"]))
    many = spark.range(300).select(F.lit(1).alias("m"), F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("v"))
    grid = J.block_grid(many, "m", "a", "b", F.sum("v"), "n")
    assert not re.search(r"hashpartitioning\(m#\d+, a#\d+L?, b#", grid._jdf.queryExecution().executedPlan().toString())
    assert grid.agg(F.sum("n"), F.count("*")).first()[:] == (44850, 90000)


def test_grid_is_dealt_by_its_rows(spark, rows, monkeypatch):
    """Before, the few bytes that a grid comes from were one task, which compared keys with keys in pairs."""
    monkeypatch.setattr(J, "GRID_ROWS", 500, raising=False)
    data = [(m, f"s{s}", float("nan") if i == 5 else float(i), 1) for m in (1, 2) for s in range(50) for i in range(60) if (s + i + m) % 7 == 0]
    df = spark.createDataFrame([*data, (1, "s0", None, 2), (2, None, 3.0, 4)], "m int, a string, b double, v int")
    got = J.block_grid(df, "m", "a", "b", F.sum("v"), "n")
    assert got.rdd.getNumPartitions() >= 12
    assert not re.search(r"array_except\(_all#\d+, .*as array<struct", got._jdf.queryExecution().optimizedPlan().toString())
    sums = df.groupBy("m", "a", "b").agg(F.sum("v").alias("n"))
    grid = sums.select("m", "a").distinct().join(sums.select("m", "b").distinct(), "m")
    joined = grid.join(sums, ["m", "a", "b"], "left").fillna(0, ["n"])
    text = [F.col(c).cast("string").alias(c) for c in ("m", "a", "b", "n")]
    assert rows(got.select(*text)) == rows(joined.select(*text))


def test_vectors_of_a_repeated_key(spark):
    """0/1 vectors hold a term once, also of a key that comes twice; before, its terms were counted by key and term."""
    lists = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["z"]), (3, [])], "k long, terms array<string>")
    vocab = spark.createDataFrame([("a", 0, 2), ("b", 1, 2), ("c", 2, 1)], "term string, index int, df long")
    before = shuffles(spark)
    got = sorted((r["k"], tuple(r["features"].indices), tuple(r["features"].values), r["total"]) for r in M.term_vectors(lists, vocab, "k", binary=True).collect())
    assert got == [(1, (0, 1, 2), (1.0, 1.0, 1.0), 3.0)] * 2 + [(2, (), (), 0.0), (3, (), (), 0.0)]
    assert shuffles(spark) <= before  # the files went with the job


def test_routes_are_given_back_in_pieces(spark, monkeypatch):
    """A query that reaches all cells has a row with its vector for each; a task gives few of them back at a time."""
    monkeypatch.setattr(N, "ROUTED", 64)
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(12)]) for i in range(400)], "vec_id long, embedding array<double>")
    sizes = []
    real = DataFrame.mapInPandas

    def watched(self, func, schema, *args, **kw):
        if "cell int" in str(schema) and "to_pivot" not in str(schema):
            pdf = self.toPandas()
            sizes.extend(len(out) for out in func(iter([pdf])))
        return real(self, func, schema, *args, **kw)

    monkeypatch.setattr(DataFrame, "mapInPandas", watched)
    got = N.knn(df, df, 3, cells=20, exclude_self=True)
    assert got.count() == 1200 and max(sizes) <= 64 and sum(sizes) > 400


def test_probes_are_given_back_in_pieces(spark, rows, monkeypatch, tmp_path):
    """Before, a task gave back a copy of the vector for each probe of all its queries at once."""
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(900)], "vec_id long, embedding array<double>")
    index = X.build_index(df, str(tmp_path / "index"), tables=2, fill=20)
    want = rows(X.search(index, df, 3, 16))
    monkeypatch.setattr(N, "ROUTED", 10)
    sizes, real = [], DataFrame.mapInPandas

    def watched(self, func, schema, *args, **kw):
        if "bucket bigint" in str(schema):
            sizes.extend(len(out) for out in func(iter([self.toPandas()])))
        return real(self, func, schema, *args, **kw)

    monkeypatch.setattr(DataFrame, "mapInPandas", watched)
    assert rows(X.search(index, df, 3, 16)) == want
    assert max(sizes) <= 10 and sum(sizes) == 900 * 2 * 16


def test_exact_search_in_rounds(spark, rows, monkeypatch):
    """Before, all queries were on the disk at once with a vector for each cell they reach."""
    rnd = random.Random(7)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(500)], "vec_id long, embedding array<double>")
    want = rows(N.knn(df, df, 3, exclude_self=True, cells=12))
    monkeypatch.setattr(N, "ROUTES_A_ROUND", 1000, raising=False)
    routed, real = [], N.materialise

    def watched(d):
        back = real(d)
        if d.columns == ["id", "v", "cell"]:
            routed.append(back.count())
        return back

    monkeypatch.setattr(N, "materialise", watched)
    before = shuffles(spark)
    assert rows(N.knn(df, df, 3, exclude_self=True, cells=12)) == want
    assert len(routed) > 3 and max(routed) < 1500
    assert shuffles(spark) - before < 8


def test_common_neighbours_in_rounds(spark, rows, monkeypatch):
    """Before, the lists of all pairs were on the disk at once."""
    monkeypatch.setattr(J, "PEERS_A_ROUND", 100, raising=False)
    rnd = random.Random(8)
    edges = {(rnd.randint(0, 30), rnd.randint(100, 140)) for _ in range(300)}
    pairs = {(rnd.randint(0, 35), rnd.choice([rnd.randint(0, 30), rnd.randint(100, 150), None])) for _ in range(120)} | {(None, None)}
    peers = {}
    for a, b in edges:
        peers.setdefault(a, set()).add(b)
        peers.setdefault(b, set()).add(a)
    written, real = [], J.materialise
    monkeypatch.setattr(J, "materialise", lambda d: written.append(d.columns) or real(d))
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    asked = spark.createDataFrame(sorted(pairs, key=str), "a long, b long")
    for light in (4096, 6):
        monkeypatch.setattr(J, "LIGHT", light)
        before = shuffles(spark)
        got = J.common_neighbours(df, asked)
        assert shuffles(spark) <= before
        want = {(a, b): len(peers.get(a, set()) & peers.get(b, set())) if None not in (a, b) else 0 for a, b in pairs}
        assert {(r["a"], r["b"]): r["common"] for r in got.collect()} == want and got.count() == len(want)
    assert written.count(["a", "b", "common"]) > 4


def _below_first_combining(df):
    """The plan under the aggregate that works first, up to the next aggregate or the leaves."""
    return df._jdf.queryExecution().executedPlan().toString().rsplit("HashAggregate(", 1)[1]


def test_plays_are_shuffled_before_they_are_combined(spark, rows):
    """Before, the task that read or joined the rows held all different plays of its input."""
    play = "timestamp_millis(0) ts0, 'NextSong' page, 5 sessionid, 'f' firstname, 'free' level, 'x' location, 'u' useragent, 1.0D length"
    events = spark.range(60).selectExpr("cast(id % 20 as bigint) ts", "cast(id % 4 as bigint) userid", "if(id % 3 = 0, null, 's1') song", "'a1' artist", *play.split(", "))
    songs = spark.sql("select 1L song_id, 1L artist_id, 's1' title, 'a1' artist_name, 1.0D duration")
    got = star.songplays(events, songs)
    assert re.search(r"Exchange hashpartitioning\(.*, REBALANCE_PARTITIONS_BY_COL", _below_first_combining(got))
    plain = got.select("start_time", "userid", "song_id").distinct()
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(playid") == 1
    assert got.count() == got.distinct().count() == plain.count() == 40


def test_ranks_travel_long(spark, rows):
    """Before, a task that held the rows of a frequent value kept a wide row for each of their ids."""
    data = [(i % 3, (i * 7) % 11, i % 5) for i in range(60)] + [(None, 1, 1)]
    df = spark.createDataFrame(data, "a int, b int, c int")
    asked = []
    real = DataFrame.repartition

    def seen(self, *cols):
        asked.append((cols, self.columns))
        return real(self, *cols)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(DataFrame, "repartition", seen)
        got = {(r["a"], r["b"]): r["rho"] for r in A.spearman(df, ["a", "b", "c"]).collect()}
    assert (("_id",), ["_id", "_w", "_c", "rank"]) in asked
    full = data[:-1]

    def rank(col):
        values = sorted(r[col] for r in full)
        return [values.index(r[col]) + (values.count(r[col]) + 1) / 2 for r in full]

    for (i, x), (j, y) in ((a, b) for a in enumerate("abc") for b in enumerate("abc") if a < b):
        assert got[x, y] == pytest.approx(np.corrcoef(rank(i), rank(j))[0, 1])


def test_boxes_of_an_image_travel_once(spark, rows, monkeypatch):
    """Images of few boxes take one write, however many rounds they would need; full ones, and boxes without an image, give the same by rounds."""
    rnd = random.Random(5)
    box = lambda: [float(x) for x in (rnd.randint(0, 9), rnd.randint(0, 9), rnd.randint(10, 30), rnd.randint(10, 30))]
    data = [(g if g < 12 else None, rnd.randint(0, 20), rnd.choice([0.1, 0.5, 0.9, None]), *box()) for g in range(13) for _ in range(2 + 3 * g)]
    df = spark.createDataFrame(data + data[:9], "img int, id int, score double, x1 double, y1 double, x2 double, y2 double")
    writes, real = [], B.materialise
    monkeypatch.setattr(B, "materialise", lambda d: writes.append(d) or real(d))
    once = rows(B.nms(df.where("img is not null"), "img", "id", max_boxes=4, limit=0.4))
    assert len(writes) <= 3 and len(once) > 24
    got = {}
    for most in (0, 14, 1000):
        monkeypatch.setattr(B, "ROW_BOXES", most)
        got[most] = rows(B.nms(df, "img", "id", max_boxes=4, limit=0.4))
    assert got[0] == got[14] == got[1000] and [r for r in got[0] if r[0] is not None] == once
    assert sum(r[0] is None for r in got[0]) == 1


def test_forest_rows_are_dealt(spark, rows, monkeypatch):
    """Rows of one packed split reach a forest in several tasks; rows that are few, or spread well, stay where they are."""
    packed = spark.range(4000).select("id", F.rand(3).alias("a"), (F.col("id") % 7).cast("double").alias("y")).coalesce(1)
    assert M.dealt(packed) is packed
    monkeypatch.setattr(M, "FOREST_ROWS", 250)
    fitted = []
    for kind in (M.RandomForestRegressor, M.RandomForestClassifier):
        monkeypatch.setattr(kind, "fit", lambda self, df: fitted.append(df))
    M.fit_forest(packed, "y")
    M.fit_forest_classifier(packed, "y")
    assert [df.rdd.getNumPartitions() for df in fitted] == [16, 16] and rows(fitted[0]) == rows(packed)
    assert max(fitted[0].rdd.glom().map(len).collect()) < 500
    even = spark.range(0, 8000, 1, 8)
    assert M.dealt(even) is even and M.dealt(even.limit(0)).count() == 0


def test_index_writes_vectors_once(spark, monkeypatch, tmp_path):
    """Only the index itself holds the vectors; before, they were written once more, and joined to the sizes of all buckets."""
    monkeypatch.setattr(X, "BLOCK_ROWS", 20)
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(4)] if i % 9 else [1.0, 0.0, 0.0, 0.0]) for i in range(400)], "vec_id long, embedding array<double>")
    written, real = [], X.materialise
    monkeypatch.setattr(X, "materialise", lambda d: written.append(d.columns) or real(d))
    index = X.build_index(df, str(tmp_path / "i"), tables=2, fill=100)
    assert not any("v" in c for c in written)
    found = index.rows.collect()
    assert sorted((r["table"], r["id"]) for r in found) == [(t, i) for t in range(2) for i in range(400)]
    size, blocks = {}, {}
    for r in found:
        at = (r["table"], r["bucket"])
        size[at] = size.get(at, 0) + 1
        blocks.setdefault(at, set()).add(r["block"])
    assert max(size.values()) > 40 and all(blocks[at] == set(range(-(-n // 20))) for at, n in size.items() if n > 40)
