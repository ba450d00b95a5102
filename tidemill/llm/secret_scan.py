"""Operator 10: secret scans by patterns and a battery of randomness tests. DataFrame functions only.

A text is read once. Three patterns give the base spans. Runs of 20 or more
characters of the usual encodings are candidates. A candidate's encoding is
inferred (hex, base32, base64), and its symbols, as numbers, take three tests
of being uniform and independent: chi-squared over the alphabet, number of runs
above and below the middle, correlation of neighbours. A candidate that fails
any (Bonferroni over the three) is no secret.

How far a candidate is from ordinary text is measured by a likelihood ratio:
uniform over its alphabet against the characters' shares in all texts. Under
the second its mean is at most 1, whatever the length, so it is an e-value: a
short string cannot reach a high one, a long one can. The e-values of all
candidates go through the e-BH step-up, which bounds the false discovery rate
by ``RATE`` under any dependence. It needs only a count per bit of evidence.
"""

from __future__ import annotations

from math import log2, pi, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.session import materialise

#: The contract's patterns: kind, pattern, group and least length of that group.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Maximal parts of one alphabet in a run that is none as a whole; = pads only at the end of the run.
PARTS = [f"[A-Za-z0-9{signs}]{{20,}}(?:=+$)?" for signs in ("+/", "_-", "")]
#: The symbols of the encodings in their order (RFC 4648).
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
CLASSES = {"lower": ("[a-z]+", 26), "upper": ("[A-Z]+", 26), "digit": ("[0-9]+", 10), "sign": ("[+/_=-]+", 5)}
ALPHA = 0.001
RATE = 0.01
#: Evidence is counted in whole bits up to this; more makes no difference.
MOST_BITS = 2000

#: Running sums and maxima are worked out in blocks of this many numbers.
BLOCK = 256


def running(numbers: Column, join) -> Column:
    """``join`` of each number with all before it. Work grows with the numbers, as arrays of one block at most are copied."""
    none = F.array().cast("array<int>")
    last = lambda x: F.get(x, F.size(x) - 1)

    def within(block: Column) -> Column:
        step = lambda done, v: F.concat(done, F.array(F.when(F.size(done) == 0, v).otherwise(join(last(done), v))))
        return F.aggregate(block, none, step)

    # Steps of a one-element array: each works its fields out once, however often the next one reads them.
    steps = F.array(F.struct(numbers.alias("x")))
    steps = F.transform(steps, lambda s: F.struct(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(s["x"]), F.lit(1)), F.lit(BLOCK)), lambda at: within(F.slice(s["x"], at, BLOCK))).alias("blocks")))
    steps = F.transform(steps, lambda s: F.struct(s["blocks"].alias("blocks"), within(F.transform(s["blocks"], last)).alias("ends")))
    joined = lambda s: F.transform(
        s["blocks"], lambda block, i: F.when(i == 0, block).otherwise(F.transform(block, lambda v: join(F.get(s["ends"], i - 1), v))))
    return F.flatten(F.transform(steps, joined)[0])


def spans_of(text: Column, pattern: str) -> Column:
    """Start, end and text of all matches, leftmost first, in code points."""
    span = lambda hit, end: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"), hits.alias("hits")))
    steps = F.transform(steps, lambda s: F.struct(
        s["hits"].alias("hits"),
        running(F.zip_with(F.slice(s["gaps"], F.lit(1), F.size(s["hits"])), s["hits"], lambda gap, hit: F.length(gap) + F.length(hit)), lambda a, b: a + b).alias("ends"),
    ))
    found = F.transform(steps, lambda s: F.zip_with(s["hits"], s["ends"], span))[0]
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def outside(base: Column, random: Column) -> Column:
    """The random spans, by start, that lie in no base span and in no longer random one.

    By start, then the longest first, then base ones, a span lies in another one if an end before it reaches its own.
    """
    placed = lambda x, late: F.transform(x, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("upto"), F.lit(late).alias("late"), s.alias("span")))
    plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("string").alias("encoding"), F.lit(None).cast("bigint").alias("bits")))
    steps = F.array(F.struct(F.array_sort(F.concat(placed(plain, 0), placed(random, 1))).alias("all")))
    steps = F.transform(steps, lambda s: F.struct(s["all"].alias("all"), running(F.transform(s["all"], lambda v: v["span"]["end"]), F.greatest).alias("reach")))
    out = lambda s: F.filter(s["all"], lambda v, i: (v["late"] == 1) & ((i == 0) | (F.get(s["reach"], i - 1) < v["span"]["end"])))
    return F.transform(F.transform(steps, out)[0], lambda v: v["span"])


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a polynomial good to 1e-7."""
    # Abramowitz and Stegun, formula 26.2.17.
    p, b = 0.2316419, [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]
    size = F.abs(z)
    t = 1 / (1 + p * size)
    tail = F.exp(-size * size / 2) / sqrt(2 * pi) * sum((c * F.pow(t, F.lit(float(i + 1))) for i, c in enumerate(b)), F.lit(0.0))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def encoding(hit: Column) -> Column:
    """hex, base32 or base64 if the characters say so, else null: plain words are not tested."""
    body = F.rtrim(hit, F.lit("="))
    digit = body.rlike("[0-9]")
    return (
        F.when(digit & body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(digit & body.rlike("^[A-Z2-7]+$"), "base32")
        .when(digit & body.rlike("[a-z]") & body.rlike("[A-Z]") & body.rlike("^([A-Za-z0-9+/]+|[A-Za-z0-9_-]+)$"), "base64")
    )


def candidates(runs: Column | str) -> Column:
    """The runs of one encoding, and of the other ones (a name or path with a secret, for instance) the parts."""

    def inner(s: Column) -> Column:
        shifted = lambda p: F.struct((s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), p["hit"].alias("hit"))
        parts = F.array(F.array_sort(F.concat(*[F.transform(spans_of(s["hit"], p), shifted) for p in PARTS])))
        # Equal parts lie side by side; array_distinct would compare all structs with each other.
        return F.transform(parts, lambda x: F.filter(x, lambda v, i: (i == 0) | (F.get(x, i - 1) != v)))[0]

    whole = lambda s: F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit")))
    return F.flatten(F.transform(runs, lambda s: F.when(encoding(s["hit"]).isNotNull(), whole(s)).otherwise(inner(s))))


def symbols(hit: Column, kind: Column) -> Column:
    """The candidate's characters as numbers from 0 in its alphabet."""
    body = F.rtrim(hit, F.lit("="))
    plain = F.when(kind == "hex", F.lower(body)).otherwise(F.translate(body, "-_", "+/"))
    letters = F.when(kind == "hex", ALPHABETS["hex"]).when(kind == "base32", ALPHABETS["base32"]).otherwise(ALPHABETS["base64"])
    return F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.position(c, letters) - 1)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda s, v: s + v)


def tested(runs: Column | str) -> Column:
    """Candidates among the runs: encoding, number of characters by class, and the battery's p-value.

    The p-value is the smallest of the three tests times three. The steps are
    transforms of their own, so that each computes its fields once a run.
    """
    named = F.filter(
        F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), encoding(s["hit"]).alias("encoding"))),
        lambda s: s["encoding"].isNotNull(),
    )
    sized = lambda s: [F.length(F.regexp_replace(s["hit"], p.replace("[", "[^"), "")).alias(c) for c, (p, _) in CLASSES.items()]
    base = lambda s: F.when(s["encoding"] == "hex", 16).when(s["encoding"] == "base32", 32).otherwise(64)
    keep = lambda s, *names: [s[n].alias(n) for n in ("start", "end", "encoding", *CLASSES, *names)]
    coded = F.transform(
        named,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), *sized(s), base(s).alias("base"), symbols(s["hit"], s["encoding"]).alias("x")),
    )
    counted = F.transform(
        coded,
        lambda s: F.struct(
            *keep(s, "base", "x"),
            F.size(s["x"]).cast("double").alias("n"),
            (total(s["x"]) / F.size(s["x"])).alias("mean"),
            F.transform(F.sequence(F.lit(0), s["base"] - 1), lambda v: F.size(F.filter(s["x"], lambda c: c == v)).cast("double")).alias("counts"),
            F.size(F.filter(s["x"], lambda c: c * 2 >= s["base"])).cast("double").alias("high"),
            F.zip_with(
                F.slice(s["x"], F.lit(1), F.size(s["x"]) - 1), F.slice(s["x"], F.lit(2), F.size(s["x"]) - 1),
                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
            ).alias("pairs"),
        ),
    )
    return F.transform(counted, lambda s: F.struct(*keep(s), battery(s).alias("p")))


def battery(s: Column) -> Column:
    """Chi-squared of the symbol counts, number of runs above and below the middle, correlation of neighbours."""
    n, base = s["n"], s["base"]
    chi = base / n * total(F.transform(s["counts"], lambda c: c * c)) - n
    spread = 2.0 / (9.0 * (base - 1))
    chi_p = upper_tail((F.pow(chi / (base - 1), F.lit(1 / 3)) - 1 + spread) / F.sqrt(spread))

    high, low = s["high"], n - s["high"]
    changes = F.size(F.filter(s["pairs"], lambda p: (p["a"] * 2 >= base) != (p["b"] * 2 >= base)))
    both = 2.0 * high * low
    runs_z = (changes - both / n) / F.sqrt(F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9)))
    runs_p = F.when(both == 0, 0.0).otherwise(2 * upper_tail(F.abs(runs_z)))

    square = total(F.transform(s["x"], lambda v: (v - s["mean"]) * (v - s["mean"])))
    lag = total(F.transform(s["pairs"], lambda p: (p["a"] - s["mean"]) * (p["b"] - s["mean"])))
    serial_p = F.when(square == 0, 0.0).otherwise(2 * upper_tail(F.abs(lag / square + 1 / n) * F.sqrt(n)))
    return F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``spans`` of each row: an array of kind (number in KINDS), start, end and encoding.

    A null text is empty and has no spans. Each row is taken for itself, so
    repeated rows give repeated results; other columns are not read. Spans go
    by start, then by kind; a random span that lies inside a base one or a longer random one is left out.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(key), body.alias("body")).select(
        key, *[(F.length("body") - F.length(F.regexp_replace("body", p, ""))).alias(f"all_{c}") for c, (p, _) in CLASSES.items()],
        F.filter(spans_of(F.col("body"), ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 8).alias("assign"),
        spans_of(F.col("body"), ACCESS).alias("access"),
        spans_of(F.col("body"), HEX).alias("hex"),
        spans_of(F.col("body"), RUN).alias("runs"),
    )
    kept = materialise(
        found.withColumn("random", tested(candidates("runs"))).drop("runs")
    )
    # Shares of the classes among the characters that candidates are made of, over all texts.
    sums = kept.agg(*[F.coalesce(F.sum(f"all_{c}"), F.lit(0)).alias(c) for c in CLASSES]).first()
    sizes = {c: sums[c] for c in CLASSES}
    every = sum(sizes.values()) + sum(n for _, n in CLASSES.values())
    share = {c: (sizes[c] + n) / every / n for c, (_, n) in CLASSES.items()}

    def bits(s: Column) -> Column:
        length = sum((s[c] for c in CLASSES), F.lit(0))
        per = F.when(s["encoding"] == "hex", 4.0).when(s["encoding"] == "base32", 5.0).otherwise(6.0)
        odds = -per * length - sum((s[c] * log2(share[c]) for c in CLASSES), F.lit(0.0))
        return F.when(s["p"] >= ALPHA, F.floor(F.least(odds, F.lit(float(MOST_BITS))))).otherwise(-1)

    graded = kept.withColumn("random", F.transform("random", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), bits(s).alias("bits"))))
    counts = graded.select(F.explode("random.bits").alias("bits")).groupBy(F.greatest("bits", F.lit(-1)).alias("bits")).count().collect()
    least = cut({r["bits"]: r["count"] for r in counts})

    def as_spans(kind: int, column: str) -> Column:
        encoded = (lambda s: s["encoding"]) if column == "random" else (lambda s: F.lit(None).cast("string"))
        return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), encoded(s).alias("encoding")))

    graded = graded.withColumn("random", F.filter("random", lambda s: s["bits"] >= least))
    base = F.concat(*[as_spans(i, k) for i, k in enumerate(KINDS[:3])])
    return (
        graded.withColumn("base", base).withColumn("random", outside(F.col("base"), F.col("random")))
        .select(key, F.array_sort(F.concat("base", as_spans(3, "random"))).alias("spans"))
    )


def cut(counts: dict[int, int], rate: float = RATE) -> int:
    """e-BH: the least whole bits of evidence that a discovery needs, given candidates by bits."""
    total, above = sum(counts.values()), 0
    least = MOST_BITS + 1
    for bits in sorted((b for b in counts if b >= 0), reverse=True):
        above += counts[bits]
        if 2.0 ** min(bits, 1000) * above >= total / rate:
            least = bits
    return least


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
