import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import modelling as M


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(scale=0.1, size=600)
    rows = [(i, *map(float, r), float(v), "g" + str(i % 3)) for i, (r, v) in enumerate(zip(x, y))]
    return M.features(spark.createDataFrame(rows, "id int, a double, b double, c double, y double, g string"), ["a", "b", "c"]).cache()


def test_forest_beats_the_mean_and_repeats(data):
    train, valid = data.where("id % 4 > 0"), data.where("id % 4 = 0")
    fits = [M.fit_forest(train, "y", trees=10, min_leaf=1) for _ in range(2)]
    r2 = [M.metrics_regression(f.transform(valid), "y", "prediction").first()["r2"] for f in fits]
    assert r2[0] > 0.6 and r2[0] == r2[1]
    top = M.importances(data, fits[0], ["a", "b", "c"]).orderBy(F.desc("importance")).first()
    assert top["feature"] == "a"
    spread = M.tree_spread(valid, fits[0], "g").collect()
    assert len(spread) == 3 and all(r["spread"] > 0 for r in spread)
    pd = {r["a"]: r["mean_prediction"] for r in M.partial_dependence(valid, fits[0], ["a", "b", "c"], {"a": [-1, 1]}).collect()}
    assert pd[1.0] > pd[-1.0]
    curves = M.dependence_curves(valid, fits[0], "id", ["a", "b", "c"], "a", [-1.0, 0.0, 1.0], clusters=2)
    assert curves.agg(F.sum("n")).first()[0] == valid.count()


def test_lasso_drops_the_noise(data):
    got = {r["feature"]: r["coefficient"] for r in M.coefficients(data, M.fit_lasso(data, "y", [0.1]), ["a", "b", "c"]).collect()}
    assert set(got) == {"a", "b"} and got["a"] > 2


def test_drop_column_and_adversarial(data):
    plain = data.drop("features")
    train, valid = plain.where("id < 450"), plain.where("id >= 450")
    loss = {r["feature"]: r["loss"] for r in M.drop_column_importance(train, valid, "y", ["a", "b", "c"], trees=5, depth=5, share="all").collect()}
    assert loss["a"] > loss["c"]
    shifted = M.adversarial_columns(train.withColumn("t", F.col("id").cast("double")), valid.withColumn("t", F.col("id").cast("double")), ["a", "t"])
    assert shifted.orderBy(F.desc("importance")).first()["feature"] == "t"


def test_logistic_and_interpolation(data):
    df = data.withColumn("label", (F.col("y") > 0).cast("double"))
    model = M.fit_logistic(df, "label", 1.0)
    assert M.metrics_classification(model.transform(df), "label", "prediction").first()["accuracy"] > 0.9
    rows = df.withColumn("total", F.col("a") + F.col("b") + F.col("c"))
    same = M.interpolated_scores(rows, model, 1.0, "pulled")
    assert same.where("pulled != prediction").count() == 0
    w, b = model.coefficients.toArray(), model.intercept
    pulled = 0.75 * abs(w).mean() + 0.25 * w
    got = M.interpolated_scores(rows, model, 0.25, "pulled").collect()
    assert [r["pulled"] for r in got] == [float(r["features"].toArray() @ pulled + b > 0) for r in got]


def test_als_beats_nothing(spark):
    rows = [(u, i, float(1 + (u % 2 == i % 2) * 4)) for u in range(20) for i in range(20)]
    r = spark.createDataFrame(rows, "u int, i int, r float")
    model = M.fit_als(r.where("(u + i) % 7 > 0"), "u", "i", "r", rank=4, iterations=8, reg=0.05)
    scored = M.clipped(model.transform(r.where("(u + i) % 7 = 0")), "prediction", 1.0, 5.0)
    assert M.metrics_regression(scored, "r", "prediction").first()["rmse"] < 1.0
    assert M.item_components(model, 2).count() == 20


def test_codes_and_imputing(spark, rows):
    train = spark.createDataFrame([("b", 1.0), ("a", None), ("b", 3.0), (None, 8.0)], "c string, v double")
    codes = M.fit_codes(train, "c")
    test = spark.createDataFrame([("a",), ("z",), (None,), ("b",)], "c string")
    assert rows(M.apply_codes(test, "c", codes)) == [(None, -1), ("a", 0), ("b", 1), ("z", -1)]
    ordered = M.fit_codes(train, "c", ["b", "a"])
    assert rows(ordered, "category", "code") == [("a", 1), ("b", 0)]
    medians = M.fit_medians(train, ["v"])
    assert medians == {"v": 3.0}
    assert M.impute(train, medians).where("v_na").first()["v"] == 3.0


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "y int, p int")
    m = M.metrics_classification(df, "y", "p").first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.5, 0.5, 0.5, 0.5)
    sweep = M.fbeta_sweep(df.withColumn("s", F.col("p") * 0.5), "y", "s", 2.0, [0.2, 0.9]).collect()
    assert sweep[0]["fbeta"] == pytest.approx(0.5) and sweep[1]["fbeta"] == 0
    assert M.soft_kappa(df, "y", "p").first()[0] == pytest.approx(-0.5)


def test_bias_model(spark):
    r = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 1, 2.0), (2, 2, 1.0)], "u int, i int, r double")
    got = {(x["u"], x["i"]): x["predicted"] for x in M.bias_model(r, "u", "i", "r", 1.0, 5.0).collect()}
    assert got == pytest.approx({(1, 1): 5.0, (1, 2): 4.0, (2, 1): 2.0, (2, 2): 1.0})


def test_split_is_even_per_label(spark):
    df = spark.range(100).select("id", (F.col("id") < 70).alias("y"))
    got = dict(M.stratified_split(df, "y", "id", 0.2).where("is_valid").groupBy("y").count().collect())
    assert got == {True: 14, False: 6}
    assert M.category_columns(spark.range(1000).select("id", (F.col("id") % 3).alias("k"))).where("is_category").first()["column"] == "k"


def test_measures_of_an_empty_class_are_null(spark):
    df = spark.createDataFrame([(0, 0, 0.0), (0, 0, 0.0)], "y int, p int, s double")
    assert tuple(M.metrics_classification(df, "y", "p").first()) == (1.0, None, None, None)
    assert [r["fbeta"] for r in M.fbeta_sweep(df, "y", "s", 2.0, [0.5]).collect()] == [None]
    assert M.soft_kappa(df, "y", "s").first()[0] is None
    assert M.metrics_regression(df, "y", "s").first()["r2"] is None


@pytest.mark.parametrize("hot", [4_000_000, 0])
def test_term_vectors(spark, monkeypatch, hot):
    monkeypatch.setattr(M.attach, "__defaults__", (hot,))
    df = spark.createDataFrame([(1, ["a", "b", "a", "zzz"]), (2, []), (3, ["zzz"])], "id int, terms array<string>")
    vocab = M.numbered_terms(spark.createDataFrame([("b", 1, -3.0), ("a", 1, None)], "term string, df long, w double"))
    dense = lambda rows: {r["id"]: (r["features"].toArray().tolist(), r["total"]) for r in rows.collect()}
    none = ([0.0, 0.0], 0.0)
    assert dense(M.term_vectors(df, vocab, "id")) == {1: ([2.0, 1.0], 3.0), 2: none, 3: none}
    assert dense(M.term_vectors(df, vocab, "id", binary=True, weight="w")) == {1: ([0.0, -3.0], -3.0), 2: none, 3: none}


def test_text_and_time_pipeline(spark):
    rows = [("a b" if i % 2 else "c d", i % 24, float(i % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "sites string, hour int, y double")
    model = M.text_time_classifier("sites", ["hour"], "y", 2, 64).fit(df)
    assert M.metrics_classification(model.transform(df), "y", "prediction").first()["accuracy"] == 1.0


def test_categories_are_learned(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "c string, k int")
    found = M.small_categories(df, ["c", "k"], 2)
    assert found == {"c": ["a", "b"]}
    assert rows(M.one_hot(df, found), "c_a", "c_b", "k") == [(0, 0, 3), (0, 1, 2), (1, 0, 1)]
    tags = spark.createDataFrame([(1, "red big"), (2, None), (3, "")], "id int, t string")
    assert M.tag_list(tags, "t") == ["big", "red"]
    assert rows(M.multi_hot(tags, "id", "t", ["big", "red"])) == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]
    with pytest.raises(ValueError):
        M.tag_list(tags, "t", most=1)


def test_group_dependence(spark, data):
    df = spark.createDataFrame([(float(i % 2), float((i + 1) % 2), float(10 * (i % 2))) for i in range(60)], "g_a double, g_b double, y double")
    model = M.fit_forest(M.features(df, ["g_a", "g_b"]), "y", trees=3, share="all")
    got = {r["column"]: r["mean_prediction"] for r in M.group_dependence(df, model, ["g_a", "g_b"], ["g_a", "g_b"]).collect()}
    assert got["g_a"] > 9 and got["g_b"] < 1
