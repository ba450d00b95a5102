import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import approximate as X
from tidemill.operators import modelling as M
from tidemill.operators import nearest as N
from tidemill.operators import recommend as R


@pytest.fixture(scope="module")
def ratings(spark):
    """Planted biases and two factors, four tenths of all pairs seen, with noise of 0.1."""
    rng = np.random.default_rng(1)
    users, items = rng.normal(size=(120, 2)), rng.normal(size=(90, 2))
    bu, bi = rng.normal(scale=0.8, size=120), rng.normal(scale=0.8, size=90)
    rows = [(u, i, float(5 + bu[u] + bi[i] + 0.7 * users[u] @ items[i] + rng.normal(scale=0.1))) for u in range(120) for i in range(90) if rng.random() < 0.4]
    r = spark.createDataFrame(rows, "u int, i int, r double")
    held = F.pmod(F.xxhash64(F.lit(3), "u", "i"), F.lit(5)) == 0
    return r.where(~held), r.where(held)


def test_planted_biases_and_factors(ratings):
    train, valid = ratings
    ids = ("u", "i", "r", -5.0, 15.0)
    loss = lambda m: R.rmse(m.predict(valid), "r", "predicted")
    joint = loss(R.fit_bias_factors(train, *ids, rank=2, rounds=4, bias_penalty=1.0, penalty=0.02))
    biases = loss(R.fit_bias_factors(train, *ids, rank=0, rounds=1, bias_penalty=0.0))
    alone = M.fit_als(train, "u", "i", "r", rank=2, iterations=10, reg=0.02)
    factors = R.rmse(M.clipped(alone.transform(valid), "prediction", -5.0, 15.0), "r", "prediction")
    assert joint < 0.2 and joint < biases / 3 and joint < factors / 2


def test_a_round_joins_its_rows_once(spark, ratings, monkeypatch):
    """Before, users' biases were joined to the rows twice a round, and what the last round leaves was worked out for nothing."""
    read, real = [], R.attach
    monkeypatch.setattr(R, "attach", lambda rows, stats, keys, weight: read.append(keys[0]) or real(rows, stats, keys, weight))
    written, write = [], R.materialise
    monkeypatch.setattr(R, "materialise", lambda df: written.append(set(df.columns)) or write(df))
    train, _ = ratings
    R.fit_bias_factors(train, "u", "i", "r", -5.0, 15.0, rank=2, rounds=2, iterations=2)
    assert read == ["u", "i", "u", "i", "u", "i"]
    assert written.count({"u", "i", "_y", "_f", "_bu"}) == 2


def test_unknown_users_and_range(spark, ratings):
    train, _ = ratings
    model = R.fit_bias_factors(train, "u", "i", "r", 4.0, 6.0, rank=2, rounds=1)
    rows = spark.createDataFrame([(0, 0), (999, 0), (0, 999), (999, 999), (None, 0)], "u int, i int")
    got = {(r["u"], r["i"]): r["predicted"] for r in model.predict(rows).collect()}
    assert len(got) == 5 and all(4.0 <= p <= 6.0 for p in got.values())
    assert got[999, 999] == pytest.approx(min(max(model.mean, 4.0), 6.0))


def _base(spark, n=6000, dim=24, groups=60):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(groups, dim))
    v = centres[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, dim))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(n, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


def test_recall_without_seeing_all_rows(spark, tmp_path):
    base = _base(spark)
    asked = base.where("vec_id % 50 = 0")
    index = X.Index(spark, X.build_index(base, str(tmp_path / "index"), "l2").path)  # as opened later
    probes = X.choose_probes(index, base, asked, 10)
    found = X.search(index, asked, 10, probes)
    assert X.recall(found, N.knn(asked, base, 10, "l2")) >= 0.9
    assert probes * index.blocks.agg(F.max("n")).first()[0] * len(index.meta[1]) < 6000 * 0.6
    assert index.rows.count() == 6000 * len(index.meta[1])
    near = found.where("query_id = base_id and distance < 0.000001").count()
    assert near == asked.where("embedding is not null").count()


def test_all_probes_are_exact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_ROWS", 40)  # full buckets and many queries are cut up
    base = _base(spark, 500, 8, 5)
    index = X.build_index(base, str(tmp_path / "index"), "cosine", tables=2)
    got = X.search(index, base, 3, 1 << index.meta[1].shape[1])
    pairs = lambda df: {(r["query_id"], r["base_id"]) for r in df.collect()}
    assert pairs(got) == pairs(N.knn(base, base, 3, "cosine"))


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    index = X.build_index(none, str(tmp_path / "index"))
    assert X.search(index, _base(spark, 20, 3, 2), 2, 4).count() == 0


def test_probe_order():
    rng = np.random.default_rng(2)
    margins = rng.normal(size=6)
    cost = [sum(margins[b] ** 2 for b in range(6) if f >> b & 1) for f in range(64)]
    assert X.probe_order(margins, 64) == sorted(range(64), key=cost.__getitem__)
    assert X.probe_order(margins, 5) == sorted(range(64), key=cost.__getitem__)[:5]
