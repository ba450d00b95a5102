"""Vector search against brute force, language identification on held-out documents, and the pipeline."""

import sys
import zlib
from pathlib import Path

import brute
import numpy as np
import pytest

from tidemill.llm import decontaminate, language_id, vector_search
from tidemill.llm.registry import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline

SMALL = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not here")


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = [(-float(np.dot(v, x)), i) for i, x in rows if i != q and len(x) == len(v)]
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r)
    return out


def test_search_edges(spark):
    rnd = np.random.default_rng(0)
    rows = [(i, rnd.integers(-4, 5, 6).astype(float).tolist()) for i in range(60)]
    rows += [(60 + i, rows[7][1]) for i in range(10)] + [(70, rows[7][1]), (70, rows[7][1])]
    bad = [(80, None), (81, [0.0] * 6), (82, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (100, [float("nan")] * 6), (84, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (86, [])]
    other = [(90, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad + other, "vec_id long, embedding array<double>")
    got = found(vector_search.nearest(df, df.where("vec_id % 10 = 0"), k=8))
    clean = list(dict((i, x) for i, x in rows if any(x)).items())
    want = exact(clean, [(i, x) for i, x in clean if i % 10 == 0], 8)
    assert {q: [r["vec_id"] for r in v] for q, v in got.items()} == want
    assert all([r["rank"] for r in v] == list(range(1, len(v) + 1)) for v in got.values())
    assert all(r["score"] == float(np.dot(dict(clean)[q], dict(clean)[r["vec_id"]])) for q, v in got.items() for r in v)
    assert vector_search.nearest(df.limit(0), df.limit(0)).count() == 0


def test_search_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 4_000)
    monkeypatch.setattr(vector_search, "QUERY_ROWS", 40)
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((9_000, 32)) * rnd.uniform(0.5, 2, (9_000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 100 = 0")
    got = found(vector_search.nearest(df, queries))
    hits = [len({r["vec_id"] for r in got[q]} & set(want)) / 20 for q, want in exact(rows, [(i, x[i]) for i in range(0, 9_000, 100)], 20).items()]
    assert np.mean(hits) >= 0.9 and len(got) == 90


@needs_tables
def test_search_tables(spark):
    data = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = found(QUERIES["op7_vector_search"](spark, SMALL))
    want = exact(data, [(i, x) for i, x in data if i % 20 == 0], 20)
    assert np.mean([len({r["vec_id"] for r in got[q]} & set(w)) / len(w) for q, w in want.items()]) >= 0.95


@needs_tables
def test_language_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in docs)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(r["rejected"] for r in got.values()) <= 0.02 * len(got)


@needs_tables
def test_language_ignores_labels_of_held_out(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.withColumn("lang", F.when(~language_id.held_out(), F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    a = sorted(tuple(r) for r in QUERIES["op3_language_id"](spark, SMALL).select("doc_id", "lang_pred").collect())
    b = sorted(tuple(r) for r in QUERIES["op3_language_id"](spark, str(tmp_path)).select("doc_id", "lang_pred").collect())
    assert a == b


@needs_tables
def test_language_rejects_what_is_far(spark, table):
    model = language_id.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    foreign = "Это предложение написано на русском языке для проверки работы. " * 20
    rows = [(1, None), (2, ""), (3, "12 + 7 = 19!"), (4, foreign), (5, "的一是在不了有和人这中大为上个国我以要他" * 30)]
    got = {r["doc_id"]: r for r in language_id.predict(table(rows), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert all(got[i]["rejected"] for i in range(1, 6))
    assert language_id.predict(table([]), model).count() == 0


@needs_tables
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_language_rejects_at_every_length(spark, sf):
    """Random letters and an unknown language in Latin letters go, short or long; real texts and pieces of them stay."""
    import random

    rnd, docs = random.Random(4), spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    model = language_id.fit(docs)
    swahili = "watoto wanacheza nje ya nyumba na mama anapika chakula cha jioni kwa ajili ya familia nzima huku baba akisoma gazeti karibu na dirisha kubwa".split()
    texts = [r["text"] for r in docs.select("text").collect()]
    assert np.mean(model.predict(texts)[2]) <= 0.02
    for size in (60, 160, 700):
        junk = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(size))[:size] for _ in range(100)]
        unknown = [" ".join(rnd.choice(swahili) for _ in range(size))[:size] for _ in range(100)]
        pieces = [t[a : a + size] for t in texts if len(t) > size for a in [rnd.randint(0, len(t) - size)]]
        assert np.mean(model.predict(junk)[2]) >= 0.98 and np.mean(model.predict(unknown)[2]) >= 0.98
        assert np.mean(model.predict(pieces)[2]) <= 0.03  # some lie in junk or license lines


@needs_tables
def test_language_plain_version(spark):
    """Slots, weights and cosines against a plain TF-IDF; every text goes to the language of its nearest centroid."""
    from math import log

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model, rows = language_id.fit(docs), docs.collect()

    def counts(text):
        raw, out = b" " + b" ".join("".join(c if not c.isascii() or c.isalpha() else " " for c in text.lower()).encode().split()) + b" ", {}
        for n in (2, 3, 4):
            for i in range(len(raw) - n + 1):
                slot = ((int.from_bytes(raw[i : i + n], "big") + n) * 2654435761 % (1 << 32)) >> 19
                out[slot] = out.get(slot, 0) + 1
        return out

    all_counts = [counts(r["text"]) for r in rows]
    df = {}
    for c in all_counts:
        for slot in c:
            df[slot] = df.get(slot, 0) + 1
    got = model.predict([r["text"] for r in rows])
    for i, c in list(enumerate(all_counts))[::10]:
        v = {slot: (1 + log(n)) * (log((1 + len(rows)) / (1 + df[slot])) + 1) for slot, n in c.items()}
        size = sum(x * x for x in v.values()) ** 0.5
        cosines = [sum(x / size * float(centre[slot]) for slot, x in v.items()) for centre in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert got[0][i] == model.languages[model.owner[best]] and abs(got[1][i] - cosines[best]) < 1e-4
    assert np.mean([lang == r["lang"] for lang, r in zip(got[0], rows)]) > 0.98


def test_taken_names_are_refused(table):
    from tidemill.llm import bpe, sharding, token_counts

    docs = table([(1, "a")])
    for call in (
        lambda: language_id.predict(docs, language_id.fit(docs), names=("lang", "score", "x")), lambda: sharding.assign(docs, ["doc_id"], [1.0]),
        lambda: token_counts.count_tokens(docs, name="Source"), lambda: bpe.encode(docs, ids="lang"),
    ):
        with pytest.raises(ValueError):
            call()


def test_nothing_learned(spark, table):
    model = language_id.fit(table([]))
    got = {r["doc_id"]: r for r in language_id.predict(table([(1, "some words"), (2, None)]), model).collect()}
    assert [(got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) for i in (1, 2)] == [("und", 0.0, False), ("und", 0.0, True)]


@needs_tables
def test_pipeline_stages(spark, tmp_path):
    """Each stage against the plain version of what it does to its own input."""
    small = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet").collect()
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before, columns = pairs(docs), docs.columns
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "bpe":
            assert docs.columns == columns
            after[name] = pairs(docs)
        if name == "language_id":
            model = language_id.fit(spark.read.parquet(f"{small}/documents.parquet"))
            far = model.predict([t for _, t in before])[2]
            assert after[name] == [p for p, out in zip(before, far) if not out]
        if name == "line_dedup":
            gone = {d: {int(x.split(":")[0]) for x in g.split(",") if x} for d, _, _, g in brute.lines(before)}
            assert after[name] == [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])) for d, t in before]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "simhash_dedup":
            keep = {d for d, _, c in brute.near(before) if d == c}
            assert after[name] == [p for p in before if p[0] in keep]
        if name == "decontaminate":
            clean = {r[0] for r in brute.benchmark(before, [(r["item_id"], r["text"]) for r in items]) if not r[5]}
            assert after[name] == [p for p in before if p[0] in clean]
        if name == "bpe":
            assert sorted(r["doc_id"] for r in docs.collect()) == [d for d, _ in before]
    whole = corpus_pipeline.run(spark, small)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_awkward(spark, table, sf):
    """Nulls, repeated rows and clashing columns pass every stage; an empty table stays empty."""
    root, _ = sf
    for rows in ([(1, "the of and to in a word"), (1, "the of and to in a word"), (None, "other words here"), (2, None), (3, "")], []):
        docs = table(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, root)
            if name == "bpe":
                assert out.count() == docs.count()
            else:
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), out.schema)


def test_words_cross_no_texts():
    found = decontaminate.Benchmark([("1", "a b c d e f g h i j")]).search(["a b c d e", "f g h i j", "a b c d e f g h i j k"])
    assert [len(f[1]) for f in found] == [0, 0, 1]
