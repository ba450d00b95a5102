"""Chat formatting, periodic runs and collocations against their plain versions."""

import random
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import chat_format, collocations, periodic_runs
from tidemill.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not here")

TURNS = "conv_id long, turn int, role string, text string, part int, formatted string, whole string"


def odd_turns():
    rnd = random.Random(4)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<", "[", " ", "\n", "é", "日本", "\U0001f600", "[\\INST]", "</\\s>", "<\\/s>"]
    say = lambda n: "".join(rnd.choice(bits) for _ in range(n))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", "[ROLE]", "", None]), rnd.choice([None, "", say(3), say(30)])) for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(None, 1, "user", "no id"), (None, None, None, None), (None, 0, "assistant", "first")]
    rows += [(100, 0, "user", "twice")] * 2 + [(100, 0, "assistant", "tie"), (100, None, "assistant", "before")]
    rows += [(200, i, ("user", "assistant")[i % 2], f"turn {i} </s>" + say(20)) for i in range(700)]
    rows += [(300, 0, "assistant", "long [INST] " * 200_000), (300, 1, "user", "after")]
    return rows


def chat_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "f", "w") for r in rows], TURNS).repartition(3)


@pytest.mark.parametrize("piece_bytes", [None, 40])
def test_chats_come_back(spark, monkeypatch, piece_bytes):
    """Control strings and escapes in texts and roles, nulls, ties, repeated rows, many turns, a long text, any pieces."""
    if piece_bytes:
        monkeypatch.setattr(chat_format, "PIECE_BYTES", piece_bytes)
    rows = odd_turns()
    pieces = chat_format.format_chats(chat_table(spark, rows))
    got = sorted((tuple(r)[:5] for r in chat_format.read_back(pieces).collect()), key=str)
    assert got == sorted(brute.chats(rows), key=str)
    texts = {}
    for r in pieces.orderBy("part", "piece").collect():
        texts.setdefault(r["conv_id"], []).append(r)
    for conv, parts in texts.items():
        assert not any(p["whole"] for p in parts) or len(parts) == 1
        assert [t for p in parts for t in chat_format.parse(p["formatted"])] == [
            (r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda t: tuple((x is not None, x) if x is not None else (False,) for x in t))
        ]


def test_no_control_string_is_left():
    texts = [t for _, _, _, t in odd_turns() if t]
    escaped = chat_format.escape(pa.array(texts)).to_pylist()
    controls = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
    assert not any(c in e for e in escaped for c in controls)
    assert [chat_format.unescape(e) for e in escaped] == texts
    with pytest.raises(ValueError):
        list(chat_format.parse("<s>[INST] open"))


def test_no_chats(spark):
    assert chat_format.read_back(chat_format.format_chats(chat_table(spark, []))).count() == 0


@needs_tables
def test_chat_query(spark, rows):
    turns = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted(brute.chats(turns + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]))
    assert rows(QUERIES["op11_chat"](spark, SMALL), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == want


def test_runs_of_random_words():
    rnd = random.Random(1)
    for _ in range(300):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            x = []
            for _ in range(rnd.randint(0, 6)):
                unit = [rnd.choice(b"abc") for _ in range(rnd.randint(1, 10))]
                x += (unit * rnd.randint(1, 9))[: rnd.randint(1, 40)] if rnd.random() < 0.6 else unit
            texts.append([bytes([c]) for c in x])
        assert periodic_runs.runs_of(texts) == [brute.periodic_runs(x) for x in texts]


def test_runs_of_extreme_texts():
    unit = [str(i).encode() for i in range(2000)]
    assert periodic_runs.runs_of([[b"a"] * 30_000, unit * 10, []]) == [[(0, 30_000, 1)], [(0, 20_000, 2000)], []]
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(18):
        a, b = b, b + a
    assert periodic_runs.runs_of([b]) == [[]]  # a Fibonacci word has no fourth power
    assert [len(x) for x in periodic_runs.neighbours(periodic_runs.ranks(np.array([0])))] == [0, 0, 0]


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_query_awkward(spark, sf, docs, rows):
    assert rows(QUERIES["op12_runs"](spark, sf[0]), *RUN_COLUMNS) == [tuple(r) for r in brute.runs(docs)]


@needs_tables
def test_runs_query(spark, rows):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op12_runs"](spark, SMALL), *RUN_COLUMNS) == brute.runs(docs)


def test_runs_keep_columns_and_rows(spark, table):
    found = periodic_runs.find_runs(table([(1, "a b " * 5), (1, "a b " * 5), (None, None), (2, "")]))
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect())
    assert got == [(0, [], ""), (1, [(0, 10, 2)], "a b"), (1, [(0, 10, 2)], "a b"), (2, [], "")]
    assert periodic_runs.find_runs(table([])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(table([]), names=("spans", "best", "collapsed"))


PHRASE_COLUMNS = ["lang", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("block,few", [(collocations.BLOCK_BYTES, 500_000), (300, 0)])
def test_collocations(spark, monkeypatch, block, few):
    """Any blocks, either way of joining; nulls, separators, other languages, tabs, repeated rows, clashing columns."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "BROADCAST_PHRASES", few)
    rnd = random.Random(3)
    say = lambda n: " ".join(rnd.choice("ab cd e É f".split()) for _ in range(n))
    texts = [None, "", " \t ", ".;!?", "a\tB  a b a b", "ab ab ab ab", "x\x0by\x0cz", "a.b,c", "a a a a a a a a"]
    docs = [(rnd.choice([None, "en", "und", "de"]), rnd.choice([*texts, say(20), say(5) + "; " + say(9) + "\n" + say(7)])) for _ in range(150)]
    docs += [("en", "A b c D e f")] * 30
    df = spark.createDataFrame([(lang, t, 1, "w") for lang, t in docs], "lang string, text string, block long, word string").repartition(3)
    for least, share in ((5, 100), (8, 80)):
        got = collocations.collocations(df, least=least, share=share).select(*PHRASE_COLUMNS).collect()
        want = [(r[0], *r[2:]) for r in brute.collocations(docs, least=least, share=share)]
        assert len(want) > 20 and sorted(map(tuple, got)) == sorted(want)


def test_no_collocations(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0
    rare = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert collocations.collocations(rare).count() == 0


def test_scores_beyond_64_bits(spark):
    """The product of counts passes 64 bits; the score does not."""
    big = spark.range(1).select(F.lit(3_000_000_000_000).alias("a"), F.lit(9_000_000_000_007).alias("n"), F.lit(3_000_000_000_001).alias("l"), F.lit(3_000_000_000_002).alias("r"))
    got = big.select(collocations.score("a", "n", "l", "r").alias("s")).first()["s"]
    assert got == 1000 * 3_000_000_000_000 * 9_000_000_000_007 // (3_000_000_000_001 * 3_000_000_000_002)
