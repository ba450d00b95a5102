"""Secrets that stand right after a name or in a path, random spans against the plain version, many spans."""

import random
import time
from collections import Counter
from pathlib import Path

import brute
import pytest

from tidemill.llm import secret_scan

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not here")


def test_glued_secrets(spark, table):
    rnd = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    say = " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(200))
    one, two = ("".join(rnd.choice(letters) for _ in range(60)) for _ in range(2))
    two = two[:30] + "_" + two[30:]
    texts = [f"{say} SIGNING_KEY={one} {say}", f"{say} https://host/hook/T0/{two} {say}", f"{say} a.b={one} {say}"]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(table(list(enumerate(texts)))).collect()}
    for i, secret in enumerate((one, two, one)):
        at = texts[i].index(secret)
        assert any(s["kind"] == 3 and s["start"] == at and s["end"] == at + len(secret) for s in got[i])


def noise(rnd):
    """A text of words, names, paths and strings of chance in several encodings, glued and apart."""
    signs = {"hex": "0123456789abcdef", "upper": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "few": "Ab1", "word": "etaoinshrdlu"}
    string = lambda: "".join(rnd.choices(signs[rnd.choice(list(signs))], k=rnd.randrange(8, 90)))
    return "".join(string() + rnd.choice([" ", " ", "\n", "/", "_", "-", "=", "==", " token=", " api_key: "]) for _ in range(rnd.randrange(12)))


def test_random_spans_against_plain(spark, table):
    rnd = random.Random(9)
    docs = [(i, noise(rnd)) for i in range(400)] + [(400, None), (401, "")]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3] for r in secret_scan.scan(table(docs)).collect()}
    expected = dict(brute.random_spans(docs))
    assert sum(map(len, expected.values())) > 300
    assert got == expected


@needs_tables
def test_random_spans_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3] for r in secret_scan.scan(docs).collect()}
    assert got == dict(brute.random_spans([tuple(r) for r in docs.collect()]))


def test_many_spans_in_one_text(spark, table):
    """Work grows with the spans: 100,000 of a kind, random ones, and one run of very many parts."""
    rnd = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = ["".join(rnd.choices(letters, k=40)) for _ in range(50)]
    texts = ["token=abcdefgh " * 100_000, " ".join(some[i % 50] for i in range(20_000)), "=".join(some[i % 50] for i in range(20_000))]
    begun = time.monotonic()
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(table(list(enumerate(texts)))).collect()}
    assert time.monotonic() - begun < 90
    assert len(got[0]) == 100_000 and got[0][-1]["end"] == len(texts[0]) - 1
    apart, glued = (Counter(texts[i][s["start"] : s["end"]].rstrip("=") for s in got[i]) for i in (1, 2))
    # A string is found everywhere or nowhere.
    assert apart == glued and set(apart) <= set(some) and len(apart) > 20 and set(apart.values()) == {400}
