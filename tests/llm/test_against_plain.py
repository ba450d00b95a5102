"""Each query against its plain version, on awkward documents and on the small tables."""

from pathlib import Path

import brute
import pytest

from tidemill.llm import decontaminate, line_dedup, secret_scan, sharding, simhash_dedup, substring_dedup
from tidemill.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"

PLAIN = {
    "op1_line_dedup": (lambda docs, items: brute.lines(docs), ["doc_id", "n_lines", "n_removed", "removed"]),
    "op4_substring": (lambda docs, items: brute.substring(docs), ["doc_id", "n_words", "n_removed", "kept_sha256"]),
    "op5_simhash": (lambda docs, items: brute.near(docs), ["doc_id", "fingerprint", "component_id"]),
    "op6_sharding": (lambda docs, items: brute.shards(docs), ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
    "op8_decontaminate": (brute.benchmark, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]),
    "op10_secrets": (lambda docs, items: [r[:5] for r in brute.secrets(docs)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]),
}


@pytest.mark.parametrize("name", PLAIN)
def test_awkward(spark, sf, docs, rows, name):
    plain, columns = PLAIN[name]
    root, items = sf
    known = [i for i in items if i[0] is not None]
    assert rows(QUERIES[name](spark, root), *columns) == plain(docs, known)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not here")
@pytest.mark.parametrize("name", PLAIN)
def test_small_tables(spark, rows, name):
    plain, columns = PLAIN[name]
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(*c).collect()]
    expected = plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert rows(QUERIES[name](spark, SMALL), *columns) == expected


def test_empty_tables(spark, table):
    none = table([])
    items = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.duplicates(none).count() == 0
    assert line_dedup.strip(none, line_dedup.duplicates(none)).count() == 0
    assert substring_dedup.dedup(none).count() == 0
    assert simhash_dedup.near_duplicates(none).count() == 0
    assert sharding.assign(none.select("doc_id"), ["doc_id"], [1.0, 2.0]).count() == 0
    assert decontaminate.find(none, items).count() == 0
    assert secret_scan.scan(none).count() == 0


def test_repeated_rows_and_null_keys(spark, table, docs, rows):
    long = docs[40][1] + " " + docs[41][1]
    some = [(1, long), (1, long), (None, long), (2, long), (None, None), (3, None)]
    kept = rows(substring_dedup.dedup(table(some)), "doc_id", "n_removed")
    n = len(long.split())
    assert kept == [(None, 0), (None, 0), (1, 0), (1, 0), (2, n), (3, 0)]
    near = rows(simhash_dedup.near_duplicates(table(some)), "doc_id", "component")
    assert near == [(None, 1), (None, 3), (1, 1), (1, 1), (2, 1), (3, 3)]
    lines = table([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "A, b c\nnew\n--")])
    stripped = rows(line_dedup.strip(lines, line_dedup.duplicates(lines)), "doc_id", "text")
    assert stripped == [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "new\n--")]
    assert sorted(r["slot"] for r in sharding.assign(table(some).select("doc_id", "text"), ["doc_id"], [1.0]).collect()) == list(range(6))
    assert secret_scan.scan(table(some)).count() == 6


def test_benchmark_slices_agree(spark, sf, rows):
    root, _ = sf
    docs, items = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/benchmark.parquet")
    whole = rows(decontaminate.find(docs, items))
    assert rows(decontaminate.find(docs, items, slice_bytes=200)) == whole
    left = sorted(r["doc_id"] for r in decontaminate.clean(docs, items, slice_bytes=200).collect())
    assert left == sorted(r[0] for r in whole if not r[4])


def test_weights_and_growth(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    shares = sharding.assign(keys, ["k"], [1.0, 3.0, 0.0]).groupBy("shard").count().collect()
    got = {r["shard"]: r["count"] for r in shares}
    assert set(got) == {0, 1} and abs(got[1] / 20_000 - 0.75) < 0.02
    before, after = sharding.rendezvous([keys.k], [1.0] * 7), sharding.rendezvous([keys.k], [1.0] * 8)
    moved = keys.select(before.alias("a"), after.alias("b")).where("a != b")
    assert moved.where("b != 7").count() == 0 and 0.1 < moved.count() / 20_000 < 0.15


def test_frequent_anchors_and_many_automata(table, docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 2)
    monkeypatch.setattr(substring_dedup, "AUTOMATON_WORDS", 50)
    found = substring_dedup.dedup(table(docs))
    assert [r[:3] for r in rows(found, "doc_id", "n_words", "n_removed")] == [r[:3] for r in brute.substring(docs)]


def test_randomness(spark, table, docs):
    """Random strings are added, words and repeated patterns are not, and base spans stay."""
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(table(docs)).collect()}
    by_text = {t: spans[d] for d, t in docs if t}
    random_text = next(t for t in by_text if t.count(" ") == 35 and len(max(t.split(), key=len)) == 64)
    assert [(s["kind"], s["encoding"]) for s in by_text[random_text]] == [(3, "base64")]
    assert [s["kind"] for s in by_text["0" * 40]] == [2]
    assert not by_text["the " * 50]


def test_evidence_cut():
    assert secret_scan.cut({}) == secret_scan.MOST_BITS + 1
    assert secret_scan.cut({-1: 50, 3: 10}) > secret_scan.MOST_BITS
    assert secret_scan.cut({-1: 1000, 40: 3, 5: 2}) == 40


def test_edit_similarity(spark):
    """Random edits of random forms: words changed, put in, taken out, moved, at either end or inside."""
    import random

    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 6)))
    rows = []
    for i in range(400):
        x = [word() for _ in range(rnd.randint(1, 25))]
        y = list(x)
        for _ in range(rnd.randint(1, 5)):
            at = rnd.randint(0, len(y))
            kind = rnd.randint(0, 3)
            if kind == 0 and at < len(y):
                y[at] = word()
            elif kind == 1:
                y[at:at] = [word() for _ in range(rnd.randint(1, 3))]
            elif kind == 2 and len(y) > 1:
                del y[max(0, at - 1)]
            elif kind == 3:
                y = y[at:] + y[:at]
        if x != y:
            rows.append((i, -i, " ".join(x), " ".join(y)))
    df = spark.createDataFrame(rows, "a int, b int, a_form string, b_form string")
    for limit in (0.8, 0.6, 0.95):
        got = {r["a"] for r in line_dedup.similar(df, limit).collect()}
        want = {i for i, _, x, y in rows if brute.edit_distance(x, y) <= int(max(len(x), len(y)) * (1 - limit) + 1e-9)}
        assert got == want


def test_template_of_all_items(spark, table, rows):
    """Items that share a template, documents with all or some of it, repeated rows; in one slice and in many."""
    template = "please read the passage below and choose the one best answer from the list given here".split()
    tails = [" ".join(f"w{i * 7 + j}" for j in range(i % 9)) for i in range(300)]
    items = [(f"i{i}", " ".join(template) + " " + t) for i, t in enumerate(tails)] + [("s1", "one two three"), ("s2", "One, two three")]
    texts = [" ".join(template), "so " + " ".join(template[3:13]), " ".join(template[:9]), items[17][1] + " and more", "one two three four", None, ""]
    texts += [" ".join(template[4:]) + " " + tails[8], " ".join(template[:12]) + " x " + " ".join(template[1:])]
    docs = list(enumerate(texts))
    expected = brute.benchmark(docs, items)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    assert max(len(places) for places in decontaminate.Benchmark(items).anchors.values()) <= decontaminate.CROWD
    for size in (decontaminate.SLICE_BYTES, 6000):
        found = decontaminate.find(table(docs + docs[:3]), benchmark, slice_bytes=size)
        got = sorted((r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["starts"], r["ends"])), len(r["items"]), brute.sha(",".join(r["items"]))) for r in found.collect())
        assert got == sorted(r[:5] for r in [*expected, *expected[:3]])
