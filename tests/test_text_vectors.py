import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import vectors as V
from tidemill.operators import boxes as B
from tidemill.operators import modelling as M
from tidemill.operators import nearest as N
from tidemill.operators import text as T


def _docs(spark, *texts):
    return T.tokenize(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text")


def test_tokens_vocab_ids(spark, rows):
    tok = _docs(spark, "The cat, the dog.", "a cat", "")
    assert rows(tok)[0] == (0, ["the", "cat", ",", "the", "dog", "."])
    vocab = T.build_vocab(T.token_counts(tok), 10, 1)
    assert rows(vocab) == [(0, "_unk_", 0), (1, "_pad_", 0), (2, "cat", 2), (3, "the", 2)]
    assert rows(T.to_ids(tok, "id", vocab, eos=9)) == [(0, [3, 2, 0, 3, 0, 0, 9]), (1, [0, 2, 9]), (2, [9])]


def test_grams(spark, rows):
    tok = _docs(spark, "a b c", "a")
    assert rows(T.grams(tok, "id", 1, 3)) == [(0, "a"), (0, "a b"), (0, "a b c"), (0, "b"), (0, "b c"), (0, "c"), (1, "a")]
    assert rows(T.grams(tok, "id", 2, 2)) == [(0, "a b"), (0, "b c")]


def test_nb_ratio_by_hand(spark):
    tok = _docs(spark, "good x", "good", "bad x", "bad")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0)], "id int, y int")
    counts = T.term_counts(tok, "id")
    model = T.nb_ratio(counts, labels, "id", "y")
    r = {x["term"]: x["r"] for x in model.collect()}
    assert r["x"] == 0 and r["good"] == pytest.approx(math.log(3)) and r["bad"] == pytest.approx(-math.log(3))
    score = {x["id"]: x["predicted"] for x in T.nb_score(counts, model, T.nb_prior(labels, "y"), "id").collect()}
    assert score == {0: True, 1: True, 2: False, 3: False}


def test_tfidf_rows_have_unit_length(spark):
    w = T.tfidf(_docs(spark, "a b a", "b c", "c"), "id", 1, 2, 50)
    for r in w.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect():
        assert r["s"] == pytest.approx(1)


def test_corpus_terms_counts_occurrences_and_documents(spark, rows):
    got = rows(T.corpus_terms(_docs(spark, "a b a b", "b", ""), "id", 1, 2), "term", "total", "df")
    assert got == [("a", 2, 1), ("a b", 2, 1), ("b", 3, 2), ("b a", 1, 1)]


def test_char_vocab(spark, rows):
    assert rows(T.char_vocab(spark.createDataFrame([("ba b",)], "t string"), "t"), "id", "ch", "n") == [(1, " ", 1), (2, "a", 1), (3, "b", 2)]


def _vecs(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id bigint, embedding array<float>")


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("cells,block", [(1, 1000), (7, 9)])
def test_knn_is_exact(spark, metric, cells, block):
    rng = np.random.default_rng(4)
    base = np.vstack([rng.normal(size=(60, 5)) + c * 3 for c in (0, 1, 5)]).astype(np.float32)
    base[10] = base[11]
    q = base[::4]
    df = _vecs(spark, base)
    queries = df.where("vec_id % 4 = 0")
    got = N.knn(queries, df, 4, metric, exclude_self=True, cells=cells, block=block).collect()
    b, a = base.astype(float), q.astype(float)
    if metric == "cosine":
        bn, an = b / np.linalg.norm(b, axis=1, keepdims=True), a / np.linalg.norm(a, axis=1, keepdims=True)
        d = 1 - an @ bn.T
        order_d = np.sqrt(np.maximum(2 * d, 0))
    else:
        d = order_d = np.linalg.norm(a[:, None] - b[None], axis=2)
    for i in range(len(q)):
        qid = i * 4
        want = sorted((round(x, 6), j) for j, x in enumerate(order_d[i]) if j != qid)[:4]
        mine = sorted((r["base_id"], r["distance"]) for r in got if r["query_id"] == qid)
        assert sorted(j for _, j in want) == [j for j, _ in mine]
        for j, x in mine:
            assert x == pytest.approx(d[i][j], abs=1e-6)


def test_knn_with_many_copies(spark):
    """A third of the rows are one vector; the nearest of a copy are its smallest other copies."""
    rng = np.random.default_rng(1)
    m = [[1.0, 2.0]] * 40 + rng.normal(size=(80, 2)).tolist()
    df = _vecs(spark, m)
    got = N.knn(df, df, 3, exclude_self=True, cells=4, block=16).collect()
    a = np.array(m, dtype=np.float32).astype(float)
    d = np.round(np.linalg.norm(a[:, None] - a[None], axis=2), N.DIGITS)
    for i in range(len(m)):
        want = sorted((d[i][j], j) for j in range(len(m)) if j != i)[:3]
        assert sorted((round(r["distance"], 6), r["base_id"]) for r in got if r["query_id"] == i) == [(round(x, 6), j) for x, j in want]


def test_zero_vectors(spark, rows):
    df = _vecs(spark, [[0, 0], [3, 4]])
    v = V.doubles(F.col("embedding"))
    assert rows(df.select(V.l2_normalise(v)[1], V.cosine(v, v))) == [(0.0, None), (0.8, 1.0)]


def test_knn_with_fewer_rows_than_k(spark, rows):
    df = _vecs(spark, [[0, 0], [3, 4]])
    assert rows(N.knn(df, df, 5, exclude_self=True)) == [(0, 1, 5.0), (1, 0, 5.0)]


def test_verify_identify_mean(spark, rows):
    df = _vecs(spark, [[0, 0], [0.5, 0], [9, 9]])
    known = spark.createDataFrame([(0, [0.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert rows(N.identify(df, known), "query_id", "identity") == [(0, 0), (1, 0), (2, None)]
    claims = df.withColumn("who", F.lit(0))
    ids = known.withColumnRenamed("vec_id", "who")
    assert rows(N.verify(claims, ids, "who"), "vec_id", "accepted") == [(0, True), (1, True), (2, False)]
    assert N.mean_vector(df, [], "embedding", "m").first()["m"] == pytest.approx([9.5 / 3, 3.0])


def test_sentence_vectors_skip_unknown(spark, rows):
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "token string, embedding array<float>")
    got = N.sentence_vectors(_docs(spark, "a a b zzz"), "id", words).first()["sentence_vec"]
    assert got == pytest.approx([2 / 3, 1 / 3])


def test_neutralise_and_equalise(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5], [0.2, -1.0, 0.3], [1.0, 0.0, 0.0])], "a array<double>, b array<double>, g array<double>")
    n = df.select(V.neutralise(F.col("a"), F.col("g"))).first()[0]
    assert n == pytest.approx([0, 2, 0.5])
    r = V.equalise(df, "a", "b", "g", "e1", "e2").first()
    assert r["e1"][0] == pytest.approx(-r["e2"][0]) and r["e1"][1:] == pytest.approx(r["e2"][1:])


def test_iou_example(spark):
    df = spark.createDataFrame([(2.0, 1.0, 4.0, 3.0, 1.0, 2.0, 3.0, 4.0)], "ax1 double, ay1 double, ax2 double, ay2 double, bx1 double, by1 double, bx2 double, by2 double")
    assert df.select(B.iou(B.cols("a"), B.cols("b"))).first()[0] == pytest.approx(1 / 7)


def _greedy(boxes, max_boxes, limit):
    def iou(a, b):
        w = max(min(a[4], b[4]) - max(a[2], b[2]), 0)
        h = max(min(a[5], b[5]) - max(a[3], b[3]), 0)
        s = (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - w * h
        return w * h / s if s else 0

    kept = []
    for b in sorted(boxes, key=lambda x: (-x[1], x[0])):
        if len(kept) < max_boxes and all(iou(b, k) <= limit for k in kept):
            kept.append(b)
    return sorted(k[0] for k in kept)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_nms_matches_greedy(spark, seed):
    rng = np.random.default_rng(seed)
    data = {}
    for image in ("p", "q"):
        data[image] = []
        for i in range(12):
            x, y, w, h = rng.integers(0, 6), rng.integers(0, 6), rng.integers(1, 6), rng.integers(1, 6)
            data[image].append((i, float(rng.integers(1, 9)), float(x), float(y), float(x + w), float(y + h)))
    flat = [(k, *b) for k, v in data.items() for b in v]
    df = spark.createDataFrame(flat, "img string, id int, score double, x1 double, y1 double, x2 double, y2 double")
    df = df.union(df.where("id = 0").withColumn("img", F.lit("one")))
    data["one"] = [b for b in data["p"][:1]]
    got = B.nms(df, "img", "id", max_boxes=3, limit=0.3).collect()
    for image in ("p", "q"):
        assert sorted(r["id"] for r in got if r["img"] == image) == _greedy(data[image], 3, 0.3)
    assert {r["id"] for r in got if r["img"] == "one"} == {0}


def test_nms_boxes_that_share_an_id(spark, rows):
    df = spark.createDataFrame([("p", 1, 0.9, 0.0, 0.0, 1.0, 1.0), ("p", 1, 0.8, 5.0, 5.0, 6.0, 6.0)], "img string, id int, score double, x1 double, y1 double, x2 double, y2 double")
    assert rows(B.nms(df, "img", "id"), "id", "score") == [(1, 0.8), (1, 0.9)]
    assert B.nms(df.limit(0), "img", "id").count() == 0


def test_box_filter(spark, rows):
    df = spark.createDataFrame([(1, 0.9, [0.1, 0.8]), (2, 0.2, [0.9, 0.1])], "id int, c double, p array<double>")
    assert rows(B.box_filter(df, F.col("c"), F.col("p"), 0.6), "id", "class") == [(1, 1)]


@pytest.mark.parametrize("by", ["total", "df"])
def test_frequent_terms_a_length_at_a_time(spark, rows, monkeypatch, by):
    """Before, all n-grams of all lengths were shuffled at once."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("aaabbbccddeefghij") for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    tokens = _docs(spark, *texts, texts[0])
    monkeypatch.setattr(T, "AT_ONCE", 0, raising=False)
    counted = []
    real = T._of_length
    monkeypatch.setattr(T, "_of_length", lambda texts, key, n, parts: counted.append((n, parts is not None)) or real(texts, key, n, parts))
    for most in (5, 40, 150, 100_000):
        want = T.top_terms(T.corpus_terms(tokens, "id", 1, 4), most, by)
        assert rows(T.frequent_terms(tokens, "id", 1, 4, most, by), "term", "total", "df") == rows(want, "term", "total", "df")
    assert counted[:4] == [(1, False), (2, True), (3, True), (4, True)] and counted[-1] == (4, False)
    odd = spark.createDataFrame([(1, ["a b", "c", "a", "b c"]), (2, ["a", None, "b", "c"])], "id long, tokens array<string>")
    want = T.top_terms(T.corpus_terms(odd, "id", 1, 3), 3, by)
    assert rows(T.frequent_terms(odd, "id", 1, 3, 3, by)) == rows(want)


def test_terms_meet_their_vocabulary(spark, rows, monkeypatch):
    """A vocabulary of bounded size goes to the terms; before, all terms were shuffled by term."""
    counts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, None), (3, "z")], "id long, term string")
    vocab = spark.createDataFrame([("a", 0, 2), ("b", 1, 1), ("c", 2, 9)], "term string, index int, df long")
    met = M.among(counts, vocab)
    assert "hashpartitioning(term" not in met._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "SENT_TERMS", 1)
    for got in (met, M.among(counts, vocab)):
        assert rows(got, "id", "term", "index") == [(1, "a", 0), (1, "b", 1), (2, "a", 0)]
