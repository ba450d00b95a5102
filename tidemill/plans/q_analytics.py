"""Queries for aggregation and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import dates
from tidemill.operators import aggregates as A
from tidemill.operators import relational as P
from tidemill.operators import windows as W
from tidemill.operators.joins import join_on, top_groups as top_rows
from tidemill.plans.q_relational import cents, day
from tidemill.plans.registry import query
from tidemill.session import TABLES

ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
SALES_ORDER = ["l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"]
SQL_ROW_ID = ", ".join(ROW_ID)
SQL_SALES_ORDER = ", ".join(SALES_ORDER)


def sales_order():
    return [F.col(c) for c in SALES_ORDER]


# ---- A: aggregation ----------------------------------------------------------


@query(
    "preagg_fact",
    """select l_returnflag, l_linestatus, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as arrival, cast(l_discount as double) as visa,
              count(*) as passengers from lineitem where l_tax < 0.05 group by all""",
)
def preagg_fact(t):
    kept = t.lineitem.where("l_tax < 0.05").withColumnRenamed("l_discount", "visa")
    df = A.group_count(kept, ["l_returnflag", "l_linestatus", "l_suppkey", "l_shipdate", "visa"], "passengers")
    return df.withColumn("arrival", day("l_shipdate")).drop("l_shipdate")


@query("row_counts", " union all ".join(f"select '{n}' as table_name, count(*) as n from {n}" for n in TABLES))
def row_counts(t):
    return A.row_counts({n: getattr(t, n) for n in TABLES})


@query(
    "max_per_group",
    "select o_custkey, max(o_totalprice) as max_o_totalprice, max(o_orderpriority) as max_o_orderpriority from orders group by 1",
)
def max_per_group(t):
    return A.group_max(t.orders, ["o_custkey"], ["o_totalprice", "o_orderpriority"])


@query(
    "list_agg",
    "select o_custkey, string_agg(o_orderkey::varchar, ',' order by o_orderdate, o_orderkey) as items from orders group by 1",
)
def list_agg(t):
    return A.list_agg(t.orders, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"])


@query(
    "sum_compare",
    """with l as (select l_orderkey as k, sum(cast(l_extendedprice as decimal(18,2))) as b from lineitem group by 1)
       select o_orderkey as k, cast(o_totalprice as double) as left_sum, cast(b as double) as right_sum,
              cast(o_totalprice as decimal(18,2)) > b as left_greater from orders join l on k = o_orderkey""",
)
def sum_compare(t):
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"))
    l = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("amount"))
    return A.compare_sums(o, l, "k", "amount").withColumns({c: F.col(c).cast("double") for c in ("left_sum", "right_sum")})


@query("dup_counts", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def dup_counts(t):
    return A.dup_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


#: What the test events hold, for the SQL twin; the query finds the values itself.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_count",
    "select strftime(ts, '%Y-%m-%d') as day, "
    + ", ".join(f"count(*) filter (where event_type = '{e}') as {e}" for e in EVENT_TYPES)
    + " from events group by 1",
)
def pivot_count(t):
    return A.pivot_count(t.events, day("ts").alias("day"), "event_type")


@query(
    "shop_revenue",
    """select l_suppkey as shop, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue from lineitem
       where l_shipdate >= date '1998-09-01' and l_shipdate < date '1998-10-01' group by 1 order by revenue desc, shop limit 10""",
)
def shop_revenue(t):
    from tidemill.sources.files import between_dates

    sept = between_dates(t.lineitem, "l_shipdate", "1998-09-01", "1998-09-30")
    sums = sept.groupBy(F.col("l_suppkey").alias("shop")).agg(F.sum(cents("l_extendedprice")).cast("double").alias("revenue"))
    return P.preview(sums, 10, [F.desc("revenue"), F.col("shop")])


@query(
    "category_revenue",
    """select p_type as category, cast(sum(case when month(o_orderdate) = 6 then cast(l_extendedprice as decimal(18,2)) end) as double) as june,
              cast(sum(case when month(o_orderdate) = 7 then cast(l_extendedprice as decimal(18,2)) end) as double) as july,
              cast(sum(case when month(o_orderdate) = 8 then cast(l_extendedprice as decimal(18,2)) end) as double) as august
       from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
       where year(o_orderdate) = 1999 group by 1""",
)
def category_revenue(t):
    o = t.orders.where(F.year("o_orderdate") == 1999).select("o_orderkey", F.month("o_orderdate").alias("m"))
    l = t.lineitem.select("l_orderkey", "l_partkey", cents("l_extendedprice").alias("price"))
    df = join_on(join_on(l, o, [("l_orderkey", "o_orderkey")]), t.part.select("p_partkey", "p_type"), [("l_partkey", "p_partkey")])
    summer = {6: "june", 7: "july", 8: "august"}
    p = A.pivot_sum(df, "p_type", "m", F.col("price"), list(summer))
    return p.select(F.col("p_type").alias("category"), *[F.col(str(m)).cast("double").alias(name) for m, name in summer.items()])


@query(
    "category_totals",
    """with f as (select p_brand, p_type, month(o_orderdate) as m, cast(l_extendedprice as decimal(18,2)) as price
                  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
                  where year(o_orderdate) = 1999 and month(o_orderdate) between 6 and 8),
            g as (select p_brand, p_type, 2 - grouping(p_brand) - grouping(p_type) as level, sum(case when m = 6 then price end) as june,
                         sum(case when m = 7 then price end) as july, sum(case when m = 8 then price end) as august, sum(price) as total
                  from f group by rollup (p_brand, p_type))
       select p_brand as brand, p_type as category, level::bigint as level, june::double as june, july::double as july, august::double as august,
              total::double as total, rank() over (partition by level order by total desc) as place from g""",
)
def category_totals(t):
    """Brands and their categories by summer revenue, with the sums of each brand and of all; place 1 is the best of its level."""
    o = t.orders.where(F.year("o_orderdate") == 1999).select("o_orderkey", F.month("o_orderdate").alias("m"))
    l = t.lineitem.select("l_orderkey", "l_partkey", cents("l_extendedprice").alias("price"))
    p = t.part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("category"))
    df = join_on(join_on(l, o, [("l_orderkey", "o_orderkey")]), p, [("l_partkey", "p_partkey")])
    got = A.pivot_totals(df, ["brand", "category"], "m", F.col("price"), {6: "june", 7: "july", 8: "august"})
    money = {c: F.col(c).cast("double") for c in ("june", "july", "august", "total")}
    return got.withColumns({**money, "level": F.col("level").cast("bigint")})


@query(
    "best_category",
    """select category, revenue from (select p_type as category, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue
         from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
         where o_orderdate >= date '1999-06-01' and o_orderdate < date '1999-09-01' group by 1) qualify rank() over (order by revenue desc) = 1""",
)
def best_category(t):
    """The category with the greatest revenue from June to August."""
    o = t.orders.where("year(o_orderdate) = 1999").select("o_orderkey", F.month("o_orderdate").alias("m"))
    l = t.lineitem.select("l_orderkey", "l_partkey", cents("l_extendedprice").alias("price"))
    df = join_on(join_on(l, o, [("l_orderkey", "o_orderkey")]), t.part.select("p_partkey", "p_type"), [("l_partkey", "p_partkey")])
    got = A.pivot_totals(df, ["p_type"], "m", F.col("price"), {6: "june", 7: "july", 8: "august"})
    return got.where("level = 1 and place = 1").select(F.col("p_type").alias("category"), F.col("total").cast("double").alias("revenue"))


@query(
    "constant_price",
    "select l_orderkey from lineitem group by 1 having count(distinct l_discount) = 1",
)
def constant_price(t):
    return A.constant_groups(t.lineitem, "l_orderkey", "l_discount")


@query(
    "daily_variance",
    """select round(var_samp(s), 4) as variance from (select l_shipdate, sum(l_quantity) as s from lineitem
       where l_returnflag <> 'R' group by 1)""",
)
def daily_variance(t):
    v = A.series_variance(t.lineitem.where("l_returnflag <> 'R'"), F.col("l_shipdate"), F.col("l_quantity"))
    return v.select(F.round("variance", 4).alias("variance"))


@query(
    "sold_not_returned",
    """select distinct l_partkey, l_suppkey from lineitem where l_returnflag <> 'R'
       except select l_partkey, l_suppkey from lineitem where l_returnflag = 'R'""",
)
def sold_not_returned(t):
    keys = ["l_partkey", "l_suppkey"]
    flags = t.lineitem.groupBy(*keys).agg(F.max(F.col("l_returnflag") == "R").alias("returned"))
    return flags.where(~F.col("returned")).select(*keys)


@query(
    "group_means",
    """select l_returnflag, round(avg(l_quantity), 6) as quantity, round(avg(l_discount), 6) as discount,
              round(avg(l_discount) / avg(l_tax), 6) as ratio from lineitem group by 1""",
)
def group_means(t):
    m = t.lineitem.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x"))
    return m.select(
        "l_returnflag", F.round("q", 6).alias("quantity"), F.round("d", 6).alias("discount"),
        F.round(F.col("d") / F.col("x"), 6).alias("ratio"),
    )


@query("value_counts", "select event_type, count(*) as n from events group by 1")
def value_counts(t):
    return A.group_count(t.events, ["event_type"]).orderBy(F.desc("n"))


@query(
    "crosstab_sum",
    """select o_orderpriority as priority, sum(case when l_returnflag = 'A' then l_quantity end) as A,
              sum(case when l_returnflag = 'N' then l_quantity end) as N, sum(case when l_returnflag = 'R' then l_quantity end) as R
       from orders join lineitem on o_orderkey = l_orderkey group by 1""",
)
def crosstab_sum(t):
    per_order = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    df = join_on(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("priority")), per_order, [("o_orderkey", "l_orderkey")])
    return A.pivot_sum(df, "priority", "l_returnflag", F.col("q"))


@query(
    "crosstab_margins",
    """select coalesce(quality::varchar, 'All') as quality, coalesce(toxic::varchar, 'All') as toxic, count(*) as n
       from labels group by cube (quality, toxic)""",
)
def crosstab_margins(t):
    return A.margins(t.labels, "quality", "toxic")


_NUMBERS = """select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
    min({c})::double as min, round(quantile_cont({c}, 0.25), 4)::double as q25, round(quantile_cont({c}, 0.5), 4)::double as q50,
    round(quantile_cont({c}, 0.75), 4)::double as q75, max({c})::double as max, count(distinct {c}) as uniques,
    count(*) - count({c}) as missing, null::varchar as top, null::bigint as freq from orders"""
_OTHERS = """select '{c}', count({c}), null, null, null, null, null, null, null, count(distinct {c}), count(*) - count({c}),
    (select {c}::varchar from orders where {c} is not null group by 1 order by count(*) desc, 1 limit 1),
    (select max(n) from (select count(*) as n from orders where {c} is not null group by {c})) from orders"""


@query(
    "profile",
    " union all ".join(
        [_NUMBERS.format(c=c) for c in ("o_orderkey", "o_custkey", "o_totalprice")]
        + [_OTHERS.format(c=c) for c in ("o_orderstatus", "o_orderdate", "o_orderpriority")]
    ),
)
def profile(t):
    return A.profile(t.orders).withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


_GAPS = {"o_orderstatus": "P", "o_orderpriority": "5-LOW"}
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "missing_ratio",
    " union all ".join(
        f"""select '{c}' as "column", round(avg(({f"nullif({c}, '{_GAPS[c]}')" if c in _GAPS else c} is null)::int), 6) as ratio from orders"""
        for c in _ORDER_COLUMNS
    ),
)
def missing_ratio(t):
    o = t.orders.withColumns({c: F.nullif(c, F.lit(v)) for c, v in _GAPS.items()})
    return A.missing_ratio(o).withColumn("ratio", F.round("ratio", 6))


@query(
    "len_percentile",
    """select round(quantile_cont(len(string_split(text, ' ')), 0.9), 4) as p from documents""",
)
def len_percentile(t):
    return A.percentile_of(t.documents, F.size(F.split("text", " ", -1)), 0.9).withColumn("p", F.round("p", 4))


@query(
    "histogram",
    """select case when n_chars < 0 then 0 when n_chars >= 20000 then 41 else cast(floor(n_chars / 500.0) as bigint) + 1 end as bin, count(*) as n
       from documents group by 1""",
)
def histogram(t):
    return A.histogram(t.documents, "n_chars", 0, 20000, 40)


@query("pearson", "select round(corr(l_quantity, l_extendedprice), 8) as r from lineitem")
def pearson(t):
    return A.pearson(t.lineitem, "l_quantity", "l_extendedprice").select(F.round("r", 8).alias("r"))


def _avg_rank(c):
    return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0"


@query(
    "spearman",
    f"""with r as (select {_avg_rank('l_quantity')} as q, {_avg_rank('l_extendedprice')} as p, {_avg_rank('l_discount')} as d from lineitem)
        select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(q, p), 6) as rho from r
        union all select 'l_quantity', 'l_discount', round(corr(q, d), 6) from r
        union all select 'l_extendedprice', 'l_discount', round(corr(p, d), 6) from r""",
)
def spearman(t):
    return A.spearman(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("rho", F.round("rho", 6))


@query(
    "weighted_median",
    """with w as (select l_extendedprice as v, sum(1 / l_extendedprice) as w from lineitem group by 1),
            c as (select v, sum(w) over (order by v desc) / (select sum(w) from w) as cum from w)
       select max(v) as weighted_median from c where cum > 0.5""",
)
def weighted_median(t):
    return A.weighted_median(t.lineitem, "l_extendedprice")


@query("best_constants", "select round(avg(l_extendedprice), 4) as mse_best, round(median(l_extendedprice), 4) as mae_best from lineitem")
def best_constants(t):
    return A.best_constants(t.lineitem, "l_extendedprice").select(F.round("mse_best", 4).alias("mse_best"), F.round("mae_best", 4).alias("mae_best"))


@query("distinct_stats", "select count(distinct o_custkey) as n_distinct, min(o_custkey) as lo, max(o_custkey) as hi from orders")
def distinct_stats(t):
    return A.distinct_stats(t.orders, "o_custkey")


@query("top_groups", "select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 20")
def top_groups(t):
    return top_rows(t.orders, "o_custkey", 20)


@query(
    "argmax_group",
    """select o_orderkey, coalesce(l_partkey, -1) as l_partkey, coalesce(l_quantity, 0) as l_quantity from orders left join
       (select * from (select *, row_number() over (partition by l_orderkey order by l_quantity * l_extendedprice desc, l_partkey desc) as rn
        from lineitem) where rn = 1) on o_orderkey = l_orderkey""",
)
def argmax_group(t):
    best = A.argmax_group(t.lineitem, "l_orderkey", [F.col("l_quantity") * F.col("l_extendedprice"), F.col("l_partkey")], ["l_partkey", "l_quantity"])
    df = join_on(t.orders.select("o_orderkey"), best, [("o_orderkey", "l_orderkey")], "left")
    return df.select("o_orderkey", F.coalesce("l_partkey", F.lit(-1)).alias("l_partkey"), F.coalesce("l_quantity", F.lit(0.0)).alias("l_quantity"))


@query(
    "corpus_stats",
    """with w as (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as token from documents)
       select (select sum(length(text)) from documents)::bigint as n_chars, (select max(length(text)) from documents)::bigint as longest,
              count(*) as n_tokens, count(distinct token) as n_vocab from w""",
)
def corpus_stats(t):
    from tidemill.operators.text import placed, token_counts, tokenize

    lens = t.documents.agg(F.sum(F.length("text")).alias("n_chars"), F.max(F.length("text")).cast("bigint").alias("longest"))
    words = tokenize(placed(t.documents, "doc_id", "text"), "doc_id", "text", r"[\p{L}\p{N}]+")
    vocab = token_counts(words).agg(F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_vocab"))
    return lens.join(F.broadcast(vocab))


@query(
    "vocab_coverage",
    """with b as (select distinct unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as token from benchmark),
            d as (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as token from documents)
       select round(avg((token in (select token from b))::int), 8) as coverage from d""",
)
def vocab_coverage(t):
    from tidemill.operators.text import each_token, placed, tokenize

    pattern = r"[\p{L}\p{N}]+"
    words = [
        each_token(tokenize(placed(df, k, "text"), k, "text", pattern)) for df, k in ((t.documents, "doc_id"), (t.benchmark, "item_id"))
    ]
    return A.coverage(*words).select(F.round("coverage", 8).alias("coverage"))


# ---- W: windows ----------------------------------------------------------------


@query(
    "keep_first",
    """select o_custkey, o_orderstatus, o_orderkey, o_totalprice from (select *, row_number() over
       (partition by o_custkey, o_orderstatus order by o_totalprice, o_orderdate desc, o_orderkey) as rn from orders) where rn = 1""",
)
def keep_first(t):
    df = W.keep_first(t.orders, ["o_custkey", "o_orderstatus"], [F.col("o_totalprice"), F.desc("o_orderdate"), F.col("o_orderkey")])
    return df.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query(
    "dup_flag",
    f"select {SQL_ROW_ID}, count(*) over (partition by l_orderkey, l_linenumber) > 1 as is_dup from lineitem",
)
def dup_flag(t):
    return W.dup_flag(t.lineitem.select(*ROW_ID), ["l_orderkey", "l_linenumber"])


@query(
    "latest_per_key",
    """select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id) as rn
       from events) where rn = 1""",
)
def latest_per_key(t):
    return W.latest(t.events, ["user_id", "event_type"], [F.desc("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


_DAILY = """with d as (select l_suppkey as store, l_shipdate::date as day, max((l_returnflag = 'R')::int) as promo,
                  max((l_linestatus = 'O' and l_tax > 0.06)::int) as holiday from lineitem group by 1, 2)"""


def _daily(t):
    l = t.lineitem.select(F.col("l_suppkey").alias("store"), F.col("l_shipdate").alias("day"), "l_returnflag", "l_linestatus", "l_tax")
    flags = {"promo": F.col("l_returnflag") == "R", "holiday": (F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.06)}
    return W.daily_flags(l, "store", "day", flags)


def _last(col, direction):
    return (
        f"last_value(case when {col} > 0 then day end ignore nulls) over (partition by store order by day {direction} "
        "rows between unbounded preceding and current row)"
    )


@query(
    "days_since",
    _DAILY
    + f""", x as (select *, {_last('promo', '')} as lp, {_last('holiday', '')} as lh from d)
        select store, strftime(day, '%Y-%m-%d') as day, promo, holiday, coalesce(date_diff('day', lp, day), 0) as "Afterpromo",
               coalesce(date_diff('day', lh, day), 0) as "Afterholiday" from x""",
)
def days_since(t):
    return W.days_since(_daily(t), "store", "day", ["promo", "holiday"]).withColumn("day", day("day"))


@query(
    "days_until",
    _DAILY
    + f""", x as (select *, {_last('promo', 'desc')} as lp from d)
        select store, strftime(day, '%Y-%m-%d') as day, coalesce(date_diff('day', lp, day), 0) as "Beforepromo" from x""",
)
def days_until(t):
    return W.days_until(_daily(t), "store", "day", ["promo"]).select("store", day("day").alias("day"), "Beforepromo")


@query(
    "rolling7",
    _DAILY
    + """ select store, strftime(day, '%Y-%m-%d') as "date",
          sum(promo) over (partition by store order by day rows between 6 preceding and current row)::bigint as promo_bw,
          sum(promo) over (partition by store order by day rows between current row and 6 following)::bigint as promo_fw from d""",
)
def rolling7(t):
    return W.rolling(_daily(t), "store", "day", ["promo"]).select("store", day("day").alias("date"), "promo_bw", "promo_fw")


def _encoded(t, scheme, order=()):
    cols = list(dict.fromkeys(ROW_ID + SALES_ORDER + ["l_quantity"]))
    enc = W.target_encode(t.lineitem.select(*cols), "l_partkey", "l_quantity", scheme, order)
    return enc.select(*ROW_ID, F.round("enc", 6).alias("enc"))


@query("enc_mean", f"select {SQL_ROW_ID}, round(avg(l_quantity) over (partition by l_partkey), 6) as enc from lineitem")
def enc_mean(t):
    return _encoded(t, "mean")


@query(
    "enc_kfold",
    f"""with p as (select *, row_number() over (order by {SQL_SALES_ORDER}) - 1 as pos, count(*) over () as n from lineitem),
        f as (select *, case when pos < (n % 5) * (n // 5 + 1) then pos // (n // 5 + 1) else n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) end as fold from p),
        s as (select l_partkey, fold, sum(l_quantity) as fs, count(*) as fc from f group by 1, 2),
        k as (select l_partkey, sum(fs) as ts, sum(fc) as tc from s group by 1)
        select {', '.join('f.' + c for c in ROW_ID)}, round(coalesce((ts - fs) / nullif(tc - fc, 0), 0.3343), 6) as enc
        from f join s on f.l_partkey = s.l_partkey and f.fold = s.fold join k on f.l_partkey = k.l_partkey""",
)
def enc_kfold(t):
    return _encoded(t, "kfold", sales_order())


@query(
    "enc_loo",
    f"""select {SQL_ROW_ID}, round(coalesce((sum(l_quantity) over w - l_quantity) / nullif(count(*) over w - 1, 0), 0.3343), 6) as enc
        from lineitem window w as (partition by l_partkey)""",
)
def enc_loo(t):
    return _encoded(t, "loo")


@query(
    "enc_smooth",
    f"""select {SQL_ROW_ID}, round((sum(l_quantity) over w + (select avg(l_quantity) from lineitem) * 100) / (count(*) over w + 100), 6) as enc
        from lineitem window w as (partition by l_partkey)""",
)
def enc_smooth(t):
    return _encoded(t, "smooth")


@query(
    "enc_expanding",
    f"""select {SQL_ROW_ID}, round(coalesce(avg(l_quantity) over (partition by l_partkey order by {SQL_SALES_ORDER}
        rows between unbounded preceding and 1 preceding), 0.3343), 6) as enc from lineitem""",
)
def enc_expanding(t):
    return _encoded(t, "expanding", sales_order())


@query(
    "missing_dates",
    """with d as (select distinct o_orderdate::date as day from orders where o_totalprice > 400000),
            r as (select unnest(range(min(day)::timestamp, max(day)::timestamp + interval 1 day, interval 1 day))::date as day from d)
       select strftime(day, '%Y-%m-%d') as day from r where day not in (select day from d)""",
)
def missing_dates(t):
    return W.missing_dates(t.orders.where("o_totalprice > 400000"), "o_orderdate").select(day("day").alias("day"))


@query(
    "char_windows",
    """select item_id, s as start, substring(text, s + 1, 8) as "window", substring(text, s + 9, 1) as next
       from (select item_id, text, unnest(range(0, length(text) - 8, 3)) as s from benchmark)""",
)
def char_windows(t):
    return W.char_windows(t.benchmark, "item_id", "text", 8, 3)


@query(
    "best_split",
    """with x as (select l_quantity as x, count(*) as c, sum(l_extendedprice) as s, sum(l_extendedprice * l_extendedprice) as s2 from lineitem group by 1),
            p as (select x, sum(c) over w as lc, sum(s) over w as ls, sum(s2) over w as ls2 from x window w as (order by x)),
            t as (select sum(c) as n, sum(s) as ts, sum(s2) as ts2 from x),
            q as (select x, lc, n - lc as rc, sqrt(ls2 / lc - (ls / lc) ** 2) * lc as a,
                         sqrt(greatest((ts2 - ls2) / nullif(n - lc, 0) - ((ts - ls) / nullif(n - lc, 0)) ** 2, 0)) * (n - lc) as b from p, t)
       select 'l_quantity' as "column", x as split, round((a + b) / 1000, 2) as score, lc::bigint as n_left
       from q where lc >= 3 and rc >= 3 order by a + b, x limit 1""",
)
def best_split(t):
    return W.best_split(t.lineitem, "l_quantity", "l_extendedprice", 3).withColumn("score", F.round(F.col("score") / 1000, 2))


@query(
    "time_split",
    """with r as (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as rn, count(*) over () as n from orders)
       select o_orderkey, rn > n - floor(n * 0.25) as is_valid from r""",
)
def time_split(t):
    o = t.orders.select("o_orderkey", "o_orderdate")
    return W.time_split(o, [F.col("o_orderdate"), F.col("o_orderkey")], frac=0.25).drop("o_orderdate")


@query(
    "time_folds",
    """with r as (select event_id, row_number() over (order by ts, event_id) as rn, count(*) over () as n from events)
       select event_id, case when rn <= n - 10 * (n // 11) then 0 else 1 + (rn - (n - 10 * (n // 11)) - 1) // (n // 11) end as block from r""",
)
def time_folds(t):
    return W.time_folds(t.events.select("event_id", "ts"), [F.col("ts"), F.col("event_id")], 10).drop("ts")


_SCORED = "(select doc_id, toxic, quality, n_chars / 20000.0 as p from labels join documents using (doc_id))"


def scored_labels(t):
    d = t.documents.select("doc_id", (F.col("n_chars") / 20000.0).alias("p"))
    return t.labels.join(d, "doc_id")


@query(
    "ranked_errors",
    f"""select * from (select 'wrong_yes' as kind, doc_id, round(p, 8) as p from {_SCORED} where quality = 0 order by p desc, doc_id limit 10)
        union all select * from (select 'wrong_no', doc_id, round(p, 8) from {_SCORED} where quality = 1 order by p, doc_id limit 10)
        union all select * from (select 'unsure', doc_id, round(p, 8) from {_SCORED} order by round(abs(p - 0.5), 8), doc_id limit 10)""",
)
def ranked_errors(t):
    s = scored_labels(t)
    parts = [
        ("wrong_yes", F.col("quality") == 0, F.desc("p")),
        ("wrong_no", F.col("quality") == 1, F.asc("p")),
        ("unsure", F.lit(True), F.round(F.abs(F.col("p") - 0.5), 8).asc()),
    ]
    from tidemill.operators.loads import union_all

    return union_all([
        W.rank_by(s, cond, [order, F.col("doc_id")], 10).select(F.lit(kind).alias("kind"), "doc_id", F.round("p", 8).alias("p"))
        for kind, cond, order in parts
    ])


_CURVE = f"""with g as (select p as t, sum(quality) as pos, count(*) as n from {_SCORED} group by 1),
    c as (select t, pos, sum(pos) over w as tp, sum(n) over w as taken, (select sum(pos) from g) as allpos from g window w as (order by t desc))"""


@query(
    "pr_curve",
    _CURVE + " select round(t, 8) as threshold, round(tp / taken, 8) as precision, round(tp / allpos, 8) as recall from c",
)
def pr_curve(t):
    return W.pr_curve(scored_labels(t), "p", "quality").select(
        *[F.round(c, 8).alias(c) for c in ("threshold", "precision", "recall")]
    )


@query(
    "pr_summary",
    _CURVE
    + """ select round(sum(tp / taken * pos) / sum(pos), 8) as average_precision,
          round(max(case when tp / taken >= 0.6 then tp / allpos end), 8) as recall from c""",
)
def pr_summary(t):
    from tidemill.session import materialise

    curve = materialise(W.pr_curve(scored_labels(t), "p", "quality"))
    both = W.average_precision(curve).join(F.broadcast(W.recall_at_precision(curve, 0.6)))
    return both.select(*[F.round(c, 8).alias(c) for c in both.columns])


@query(
    "daily_active",
    "select strftime(ts, '%Y-%m-%d') as day, count(*) as n, count(distinct user_id) as users from events group by 1",
)
def daily_active(t):
    per_user = t.events.groupBy(F.col("ts").cast("date").alias("d"), "user_id").agg(F.count(F.lit(1)).alias("c"))
    return per_user.groupBy(dates.day_text(F.col("d")).alias("day")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("users"))
