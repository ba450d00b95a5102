"""Join operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.scale import attach
from tidemill.session import discard, materialise, shuffles_dropped

Pairs = Sequence[tuple[str, str]]


def _cond(l: DataFrame, r: DataFrame, pairs: Pairs, null_safe: bool = False) -> Column:
    cond = None
    for a, b in pairs:
        test = l[a].eqNullSafe(r[b]) if null_safe else l[a] == r[b]
        cond = test if cond is None else cond & test
    return cond


def join_on(l: DataFrame, r: DataFrame, pairs: Pairs, how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; Spark picks the strategy by size."""
    return l.join(r, _cond(l, r, pairs), how)


def join_rounded(l: DataFrame, r: DataFrame, pairs: Pairs, number: tuple[str, str], scale: int | None, how: str) -> DataFrame:
    """Equi-join with one numeric key, compared exactly or as decimal(18, scale)."""
    a, b = number
    if scale is None:
        return join_on(l, r, [*pairs, number], how)
    kind = f"decimal(18,{scale})"
    lk, rk = l.withColumn("_lk", F.col(a).cast(kind)), r.withColumn("_rk", F.col(b).cast(kind))
    return join_on(lk, rk, [*pairs, ("_lk", "_rk")], how).drop("_lk", "_rk")


def only_new(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` does not hold (also: skip seen ids)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def merge_indicator(l: DataFrame, r: DataFrame, pairs: Pairs) -> DataFrame:
    """Full outer join with ``_merge`` = left_only, both or right_only.

    A null key equals a null key, as data-frame libraries merge it. Columns must
    not share names across the sides.
    """
    lt, rt = l.withColumn("_in_l", F.lit(1)), r.withColumn("_in_r", F.lit(1))
    side = (
        F.when(F.col("_in_r").isNull(), "left_only")
        .when(F.col("_in_l").isNull(), "right_only")
        .otherwise("both")
    )
    return lt.join(rt, _cond(lt, rt, pairs, null_safe=True), "full_outer").withColumn("_merge", side).drop("_in_l", "_in_r")


def join_suffix(l: DataFrame, r: DataFrame, on: Sequence[str], suffix: str = "_y") -> DataFrame:
    """Left join; clashing right columns get ``suffix`` (drop them by suffix later)."""
    names = {c: c + suffix for c in r.columns if c in l.columns and c not in on}
    return l.join(r.withColumnsRenamed(names), list(on), "left")


def enrich(df: DataFrame, steps: Sequence[tuple[DataFrame, Pairs, str]]) -> tuple[DataFrame, DataFrame]:
    """Chain of left joins; ``steps`` are (table, key pairs, marker column).

    Second result: one row per step with the number of rows it left unmatched,
    all counted in a single aggregation over the joined rows.
    """
    for table, pairs, _ in steps:
        df = join_on(df, table, pairs, "left")
    counts = df.agg(*[F.sum(F.col(m).isNull().cast("bigint")).alias(m) for _, _, m in steps])
    entries = ", ".join(f"'{m}', `{m}`" for _, _, m in steps)
    return df, counts.selectExpr(f"stack({len(steps)}, {entries}) as (step, unmatched)")


def join_normalised(l: DataFrame, r: DataFrame, lk: Column, rk: Column, how: str = "inner") -> DataFrame:
    """Join on cleaned-up key text: each side computes its key once, then equi-join."""
    ln, rn = l.withColumn("_lk", lk), r.withColumn("_rk", rk)
    return ln.join(rn, ln["_lk"] == rn["_rk"], how).drop("_lk", "_rk")


def match_amount(l: DataFrame, r: DataFrame, key: tuple[str, str], amount: tuple[str, str], scale: int = 2, how: str = "inner") -> DataFrame:
    """Match on a key and on an amount rounded to ``scale`` digits."""
    return join_rounded(l, r, [key], amount, scale, how)


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` largest groups by row count; ties go to the smaller key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(key)).limit(n)


def semi_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the ``n`` largest groups; the key list has at most ``n`` rows."""
    return df.join(F.broadcast(top_groups(df, key, n).select(key)), key, "left_semi")


def match_count(name: str, l: DataFrame, r: DataFrame, pairs: Pairs) -> DataFrame:
    """(check, matched): how many left rows find a partner.

    The right side is reduced to its distinct keys first.
    """
    keys = r.select(*[F.col(b) for _, b in pairs]).distinct()
    hit = l.join(keys, _cond(l, keys, pairs), "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("matched")).select(F.lit(name).alias("check"), "matched")


def lookup(df: DataFrame, col: str, dictionary: DataFrame, key: str, value: str, default, out: str) -> DataFrame:
    """Value of a dictionary table, or ``default`` where the key is unknown."""
    d = dictionary.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return df.join(d, df[col] == d["_k"], "left").withColumn(out, F.coalesce("_v", F.lit(default))).drop("_k", "_v")


#: Keys of a block of a grid that travel together, about.
GRID_SLOT = 8192
#: Rows of a grid that a task makes, about.
GRID_ROWS = 2_000_000


def block_grid(df: DataFrame, block: str, a: str, b: str, measure: Column, out: str) -> DataFrame:
    """Every a x b combination of each block with the summed measure, 0 if none.

    The dense grid is the result itself; it has sum(|a| * |b|) rows, so a and b
    should be dimension keys. Its rows come into being in the last step and are never
    shuffled: the keys b of a block travel in lists of about ``GRID_SLOT``, which meet
    the keys a; what a list has beyond an a's own keys is put out with 0. The few bytes that
    many rows come from are dealt to as many tasks as these rows ask for. Lists hold the keys
    themselves, whose difference is found by a hash; a null key b is added by a join of its own. Keys
    that are NaN are equal, as in a join.
    """
    sums = materialise(df.groupBy(block, a, b).agg(measure.alias(out)))
    known = sums.where(F.col(block).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull())
    slots = ceil(sums.select(b).distinct().count() / GRID_SLOT) or 1
    slot = F.pmod(F.xxhash64(b), F.lit(slots)).alias("_slot")
    left, every = sums.select(block, a).distinct(), sums.select(block, b).distinct()
    sizes = left.groupBy(block).agg(F.count(F.lit(1)).alias("_a")).join(every.groupBy(block).agg(F.count(F.lit(1)).alias("_b")), block)
    tasks = ceil((sizes.agg(F.sum(F.col("_a") * F.col("_b"))).first()[0] or 0) / GRID_ROWS) or 1
    # Each list goes to several lanes, a few of which make the rows of a task.
    lanes = F.lit(ceil(4 * tasks / slots))
    right = every.where(F.col(b).isNotNull()).groupBy(block, slot).agg(F.collect_list(b).alias("_all"))
    own = known.groupBy(block, a, slot).agg(F.collect_list(b).alias("_own"))
    met = left.join(right.select(block, "_slot"), block).join(own, [block, a, "_slot"], "left")
    lane = F.pmod(F.xxhash64(F.lit(1), a), lanes).cast("int")
    places = [block, "_slot", "_lane"]
    sent = right.withColumn("_lane", F.explode(F.sequence(F.lit(0), (lanes - 1).cast("int"))))
    cells = met.withColumn("_lane", lane).repartition(tasks, *places).join(sent.repartition(tasks, *places), places)
    rest = F.array_except("_all", F.coalesce("_own", F.array().cast(right.schema["_all"].dataType)))
    zeros = cells.select(block, a, F.explode(rest).alias(b))
    unnamed = left.join(every.where(F.col(b).isNull()), block).select(block, a, b)
    empty = zeros.unionByName(unnamed).withColumn(out, F.lit(None).cast(sums.schema[out].dataType))
    return known.select(block, a, b, out).unionByName(empty).fillna(0, [out])


#: Neighbours of a node that are gathered into one list, at most (8 bytes each).
LIGHT = 4096
#: Neighbours that travel with the pairs of a round, about (8 bytes each).
PEERS_A_ROUND = 250_000_000


def common_neighbours(edges: DataFrame, pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Number of shared neighbours of each given pair (columns ``a``, ``b``).

    Edges are undirected. Only the given pairs are scored. The neighbours of nodes with up to
    ``LIGHT`` of them are kept as lists: the list of the end with fewer goes with the
    pair to the other end, where both lists are intersected; no neighbour is a row.
    Pairs with a heavier end, whose lists are not gathered, are expanded over the end with
    fewer neighbours, so one hub does not multiply the work.

    Distinct edges, degrees, pairs and the lists of their ends are written once, as several steps read each. Pairs
    are worked off in rounds, by a hash of the end that is not sent, with about ``PEERS_A_ROUND`` neighbours each;
    a round's counts are written and its shuffle files go.
    """
    with shuffles_dropped(edges.sparkSession):
        both = materialise(
            edges.select(F.col(src).alias("node"), F.col(dst).alias("peer"))
            .union(edges.select(F.col(dst), F.col(src)))
            .distinct()
        )
        degree = materialise(both.groupBy("node").agg(F.count(F.lit(1)).alias("deg")))
        p = materialise(pairs.select("a", "b").distinct())
        hubs = not degree.where(F.col("deg") > LIGHT).isEmpty()
        sized = p
        for end in ("a", "b"):
            uses = p.groupBy(end).agg(F.count(F.lit(1)).alias("_n"))
            stats = uses.join(degree, uses[end] == degree["node"], "left").select(
                end, "_n", F.col("deg").alias(f"deg_{end}")
            )
            sized = attach(sized, stats, [end], "_n").drop("_n")
        swap = F.coalesce("deg_b", F.lit(0)) < F.coalesce("deg_a", F.lit(0))
        most = F.greatest("deg_a", "deg_b")  # of the one that is known, if one has no edges
        small = materialise(sized.select(
            "a", "b", F.when(swap, F.col("b")).otherwise(F.col("a")).alias("node"),
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("other"), (F.coalesce(most, F.lit(0)) <= LIGHT).alias("light"),
            F.coalesce(F.least(F.coalesce("deg_a", F.lit(0)), F.coalesce("deg_b", F.lit(0))), F.lit(0)).alias("sent"),
        ))
        discard(p)
        listed = both.join(degree.where(F.col("deg") <= LIGHT).select("node"), "node") if hubs else both.where(F.col("node").isNotNull())
        ends = small.select("node").union(small.select("other")).distinct()
        lists = materialise(listed.join(ends, "node", "left_semi").groupBy("node").agg(F.collect_list("peer").alias("peers")))
        met = small.where("light")
        rounds = ceil((met.agg(F.sum("sent")).first()[0] or 0) / PEERS_A_ROUND) or 1
        mine = lists.select("node", F.col("peers").alias("mine"))
        theirs = lists.select(F.col("node").alias("other"), F.col("peers").alias("theirs"))
        common = F.when(F.col("mine").isNotNull() & F.col("theirs").isNotNull(), F.size(F.array_intersect("mine", "theirs")))
        counts = []
        for r in range(rounds):
            part = lambda df: df.where(F.pmod(F.xxhash64("other"), F.lit(rounds)) == r) if rounds > 1 else df  # noqa: B023, E731
            now = part(met).select("a", "b", "node", "other").join(mine, "node", "left").join(part(theirs), "other", "left")
            counts.append(materialise(now.select("a", "b", F.coalesce(common, F.lit(0)).cast("bigint").alias("common"))))
        discard(lists, degree)
    few = reduce(DataFrame.unionByName, counts)
    if not hubs:
        discard(both, small)
        return few
    heavy = small.where("not light")
    hits = heavy.join(both, "node").select("a", "b", F.col("other").alias("node"), "peer").join(both, ["node", "peer"], "left_semi")
    counted = hits.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    return few.unionByName(heavy.select("a", "b").join(counted, ["a", "b"], "left").fillna(0, ["common"]))
