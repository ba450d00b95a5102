"""Queries for projection, filter, scalar functions, joins and load operators."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from tidemill.functions import dates, maths, strings
from tidemill.operators import joins as J
from tidemill.operators import loads as U
from tidemill.operators import relational as P
from tidemill.operators.scale import top_per_key
from tidemill.plans.registry import query
from tidemill.session import materialise

MONEY = "decimal(18,2)"


def cents(col: str):
    return F.col(col).cast(MONEY)


def day(col: str):
    return dates.day_text(F.col(col))


# ---- P: projection, filter, conditional -----------------------------------


@query("dim_users", "select distinct c_custkey as user_id, c_name as name, c_mktsegment as level from customer")
def dim_users(t):
    return P.distinct_cols(t.customer, ["c_custkey", "c_name", "c_mktsegment"]).toDF("user_id", "name", "level")


@query(
    "dim_songs",
    "select distinct p_partkey as song_id, p_name as title, p_brand as artist, p_retailprice as duration from part",
)
def dim_songs(t):
    return P.distinct_cols(t.part, ["p_partkey", "p_name", "p_brand", "p_retailprice"]).toDF(
        "song_id", "title", "artist", "duration"
    )


@query("dim_artists", "select distinct s_suppkey as artist_id, s_name as name, s_nationkey as location from supplier")
def dim_artists(t):
    return P.distinct_cols(t.supplier, ["s_suppkey", "s_name", "s_nationkey"]).toDF("artist_id", "name", "location")


@query("filter_page", "select event_id, user_id, value from events where event_type = 'purchase'")
def filter_page(t):
    return P.keep(t.events, F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query(
    "code_lists",
    """select o_orderkey, o_orderstatus, o_orderpriority from orders
       where o_orderstatus in ('F', 'O') and o_orderpriority not in ('1-URGENT', '5-LOW')""",
)
def code_lists(t):
    kept = P.keep_codes(t.orders, "o_orderstatus", include=["F", "O"])
    kept = P.keep_codes(kept, "o_orderpriority", exclude=["1-URGENT", "5-LOW"])
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "reject_null_keys",
    """with e as (select event_id, nullif(event_type, 'error') as page,
                        case when value < 1 then null else value end as length from events)
       select event_id, page, length from e where page is not null and length is not null""",
)
def reject_null_keys(t):
    e = t.events.select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("page"),
        F.when(F.col("value") >= 1, F.col("value")).alias("length"),
    )
    return P.drop_null_keys(e, ["page", "length"])


@query(
    "recent_window",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as order_day from orders
       where o_orderdate >= date '2001-08-01' - 15""",
)
def recent_window(t):
    return P.recent(t.orders, "o_orderdate", 15, "2001-08-01").select("o_orderkey", day("o_orderdate").alias("order_day"))


@query(
    "cond_overwrite",
    """select l_orderkey, l_linenumber, l_partkey,
              case when l_returnflag = 'R' then 0.0 else l_quantity end as l_quantity from lineitem""",
)
def cond_overwrite(t):
    df = P.overwrite_where(t.lineitem, "l_quantity", F.col("l_returnflag") == "R", 0.0)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "clip_values",
    """select l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity, 5.0), 24.0) as l_quantity from lineitem""",
)
def clip_values(t):
    return P.clip(t.lineitem, "l_quantity", 5.0, 24.0).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "case_map",
    """select o_orderkey, case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'NOT_ATTEMPTED'
              else 'FAILURE' end as tx_status from orders""",
)
def case_map(t):
    df = P.map_codes(t.orders, "o_orderstatus", {"F": "SUCCESS", "O": "NOT_ATTEMPTED"}, "FAILURE", "tx_status")
    return df.select("o_orderkey", "tx_status")


@query("safe_names", "select n_nationkey as Nation_Key, n_name as State_Code, n_regionkey as Foreign_born from nation")
def safe_names(t):
    return P.safe_names(t.nation.toDF("Nation Key", "State Code", "Foreign-born"))


@query(
    "drop_suffix",
    """select o.o_orderkey as orderkey, o.o_custkey as custkey, o.o_totalprice as amount, c.c_mktsegment as segment
       from orders o left join customer c on o.o_custkey = c.c_custkey""",
)
def drop_suffix(t):
    o = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"))
    c = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment"))
    return P.drop_suffix(J.join_suffix(o, c, ["custkey"]), "_y")


@query(
    "fill_sentinel",
    """select c_custkey, cast(coalesce(case when c_acctbal >= 0 then floor(c_acctbal) end, 1900) as bigint) as balance,
              coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as segment from customer""",
)
def fill_sentinel(t):
    df = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal")).alias("balance"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )
    return P.fill_cast(df, {"balance": (1900, "bigint"), "segment": ("none", "string")})


@query("bool_flag", "select l_orderkey, l_linenumber, l_partkey, l_returnflag <> 'N' as has_flag from lineitem")
def bool_flag(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") != "N").alias("has_flag"))


@query(
    "revenue_col",
    """select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_quantity, 2) as revenue,
              year(l_shipdate) - 1995 as age from lineitem""",
)
def revenue_col(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice") * F.col("l_quantity"), 2).alias("revenue"),
        (F.year("l_shipdate") - 1995).alias("age"),
    )


@query(
    "season_bucket",
    """select case when m between 3 and 5 then 'spring' when m between 6 and 8 then 'summer'
                   when m between 9 and 11 then 'autumn' else 'winter' end as season, count(*) as n
       from (select month(o_orderdate) as m from orders) group by 1""",
)
def season_bucket(t):
    return t.orders.groupBy(dates.season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "daypart",
    """select case when h between 7 and 11 then 'morning' when h between 12 and 18 then 'day'
                   when h between 19 and 23 then 'evening' else 'night' end as part, count(*) as n
       from (select hour(ts) as h from events) group by 1""",
)
def daypart(t):
    return t.events.groupBy(dates.daypart(F.hour("ts")).alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("preview_limit", "select n_nationkey, n_name from nation order by n_nationkey limit 5")
def preview_limit(t):
    return P.preview(t.nation.select("n_nationkey", "n_name"), 5, [F.col("n_nationkey")])


@query("hash_sample", "select o_orderkey, o_totalprice from orders order by md5('42-' || o_orderkey), o_orderkey limit 100")
def hash_sample(t):
    return P.sample_hash(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query(
    "quad_expand",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity as q_x, l_discount as q_y,
              round(l_quantity * l_quantity, 6) as q_xx, round(l_discount * l_discount, 6) as q_yy,
              round(l_quantity * l_discount, 6) as q_xy, 1.0::double as q_one from lineitem""",
)
def quad_expand(t):
    df = P.quad_expand(t.lineitem, "l_quantity", "l_discount")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "q_x", "q_y",
        *[F.round(c, 6).alias(c) for c in ("q_xx", "q_yy", "q_xy")], "q_one",
    )


# ---- F: scalar functions ---------------------------------------------------


@query(
    "epoch_ts",
    """select event_id, epoch_us(ts) // 1000 as ms, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as start_time
       from events""",
)
def epoch_ts(t):
    ms = t.events.select("event_id", dates.to_epoch_ms(F.col("ts")).alias("ms"))
    return ms.withColumn("start_time", F.date_format(dates.epoch_ms(F.col("ms").cast("string")), "yyyy-MM-dd HH:mm:ss"))


@query(
    "dim_time",
    """select distinct strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as start_time, hour(ts) as hour, day(ts) as day,
              weekofyear(ts) as week, month(ts) as month, year(ts) as year, isodow(ts) - 1 as weekday,
              dayofweek(ts) as weekday_sunday from events""",
)
def dim_time(t):
    sec = t.events.select(F.date_trunc("second", "ts").alias("ts")).distinct()
    parts = dates.time_parts(sec, "ts").withColumn("weekday_sunday", F.dayofweek("ts") - 1)
    return parts.withColumn("start_time", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).drop("ts")


@query(
    "sas_date",
    """select sas_day, strftime(date '1960-01-01' + cast(sas_day as int), '%Y-%m-%d') as arrival, count(*) as n
       from (select date_diff('day', date '1960-01-01', l_shipdate::date) as sas_day from lineitem) group by sas_day""",
)
def sas_date(t):
    num = F.datediff("l_shipdate", F.lit("1960-01-01").cast("date"))
    per_day = t.lineitem.groupBy(num.alias("sas_day")).agg(F.count(F.lit(1)).alias("n"))
    return per_day.withColumn("arrival", dates.day_text(dates.sas_date(F.col("sas_day").cast("double"))))


@query(
    "parse_dates",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as dotted,
              case when day(o_orderdate) <= 12 then strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d')
              end as swapped from orders""",
)
def parse_dates(t):
    return t.orders.select(
        "o_orderkey",
        dates.day_text(dates.parse_date(F.date_format("o_orderdate", "dd.MM.yyyy"), "dd.MM.yyyy")).alias("dotted"),
        dates.day_text(dates.parse_date(F.date_format("o_orderdate", "yyyyddMM"), "yyyyMMdd")).alias("swapped"),
    )


@query(
    "datepart",
    """select o_orderkey, year(d) as year, month(d) as month, weekofyear(d) as week, day(d) as day,
              isodow(d) - 1 as dayofweek, dayofyear(d) as dayofyear,
              d = last_day(d) as is_month_end, day(d) = 1 as is_month_start,
              (month(d) in (3, 6, 9, 12) and d = last_day(d)) as is_quarter_end,
              (month(d) in (1, 4, 7, 10) and day(d) = 1) as is_quarter_start,
              (month(d) = 12 and day(d) = 31) as is_year_end, (month(d) = 1 and day(d) = 1) as is_year_start,
              cast(epoch(o_orderdate) as bigint) as elapsed
       from (select o_orderkey, o_orderdate, o_orderdate::date as d from orders)""",
)
def datepart(t):
    return dates.add_datepart(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "iso_monday",
    """select distinct isoyear(o_orderdate) as y, weekofyear(o_orderdate) as w,
              strftime(o_orderdate::date - cast(isodow(o_orderdate) - 1 as int), '%Y-%m-%d') as monday,
              strftime(make_date(isoyear(o_orderdate), month(o_orderdate), 15), '%Y-%m-%d') as mid from orders""",
)
def iso_monday(t):
    yw = t.orders.select(
        F.extract(F.lit("YEAROFWEEK"), "o_orderdate").alias("y"),
        F.weekofyear("o_orderdate").alias("w"), F.month("o_orderdate").alias("m"),
    ).distinct()
    return yw.select(
        "y", "w",
        dates.day_text(dates.iso_monday(F.col("y"), F.col("w"))).alias("monday"),
        dates.day_text(dates.mid_month(F.col("y"), F.col("m"))).alias("mid"),
    )


@query(
    "days_open",
    """with d as (select o_orderkey, greatest(date_diff('day', date '1998-06-15', o_orderdate::date), 0) as n from orders)
       select o_orderkey, n as days, least(n // 30, 24) as months, least(n // 7, 25) as weeks from d""",
)
def days_open(t):
    n = dates.days_between(F.col("o_orderdate"), dates.mid_month(F.lit(1998), F.lit(6)))
    df = P.clip(t.orders.select("o_orderkey", n.alias("days")), "days", lo=0)
    df = df.withColumns({"months": F.expr("days div 30"), "weeks": F.expr("days div 7")})
    return P.clip(P.clip(df, "months", hi=24), "weeks", hi=25)


@query(
    "days_to_refund",
    """select l_orderkey, l_linenumber, l_partkey,
              cast(ceil(date_diff('second', o_orderdate, l_shipdate + interval 7 hour) / 86400.0) as bigint) as days
       from lineitem join orders on l_orderkey = o_orderkey""",
)
def days_to_refund(t):
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_shipdate") + F.expr("interval 7 hours")).alias("settled"))
    o = t.orders.select("o_orderkey", "o_orderdate")
    return J.join_on(l, o, [("l_orderkey", "o_orderkey")]).select(
        "l_orderkey", "l_linenumber", "l_partkey", dates.days_ceil(F.col("settled"), F.col("o_orderdate")).alias("days")
    )


@query(
    "date_swap",
    """with s as (select o_orderkey, o_orderdate::date as d, date '1999-06-30' as settled from orders),
            w as (select *, case when day(d) <= 12 then make_date(year(d), day(d), month(d)) end as sw from s)
       select o_orderkey, strftime(case when settled < d and sw < settled then sw else d end, '%Y-%m-%d') as txn_day from w""",
)
def date_swap(t):
    fixed = dates.swap_day_month(F.col("o_orderdate"), F.lit("1999-06-30"))
    return t.orders.select("o_orderkey", dates.day_text(fixed).alias("txn_day"))


@query("play_key", "select event_id, md5(user_id::varchar || strftime(ts, '%Y-%m-%d %H:%M:%S')) as playid from events")
def play_key(t):
    return t.events.select("event_id", dates.play_key(F.col("user_id"), F.col("ts")).alias("playid"))


@query("split_part", "select p_partkey, split_part(p_name, ' ', 1) as first, split_part(p_name, ' ', -1) as last from part")
def split_part(t):
    name = F.col("p_name")
    return t.part.select("p_partkey", strings.part(name, " ", 1).alias("first"), strings.part(name, " ", -1).alias("last"))


@query(
    "string_ops",
    """select c_custkey, trim('  ' || c_name || ' ') as trimmed, lower(c_name) as low, upper(c_mktsegment) as up,
              c_name || '-' || c_mktsegment as both, substring(c_name, 1, 8) as head,
              contains(c_mktsegment, 'BUILD') as has_build, starts_with(c_name, 'Customer') as is_customer from customer""",
)
def string_ops(t):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"), F.lower(name).alias("low"),
        F.upper(seg).alias("up"), F.concat(name, F.lit("-"), seg).alias("both"), F.substring(name, 1, 8).alias("head"),
        seg.contains("BUILD").alias("has_build"), name.startswith("Customer").alias("is_customer"),
    )


@query(
    "question_pairs",
    r"""with u as (select conv_id, turn, translate(text, '.', '?') as q from conversations where role = 'user'),
            a as (select conv_id, turn, text as r from conversations where role = 'assistant')
        select u.conv_id, u.turn, regexp_extract(q, '^([^?.!]+\?)', 1) as question, length(r) as answer_chars
        from u join a on u.conv_id = a.conv_id and a.turn = u.turn + 1
        where regexp_extract(q, '^([^?.!]+\?)', 1) <> ''""",
)
def question_pairs(t):
    c = t.conversations
    u = c.where("role = 'user'").select("conv_id", "turn", F.translate("text", ".", "?").alias("q"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.length("text").alias("answer_chars"))
    asked = u.withColumn("question", strings.question(F.col("q"), "fr")).dropna(subset=["question"])
    return asked.join(a, ["conv_id", "turn"]).select("conv_id", "turn", "question", "answer_chars")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _sql_fixup(expr: str) -> str:
    """Literal fixes one by one, then all named references by folding over their list, the ampersands last."""
    for old, new in strings.LITERAL_FIXES:
        expr = f"replace({expr}, {_sql_text(old)}, {_sql_text(new)})"
    names = sorted((n for n in html5 if n.endswith(";")), key=lambda n: (html5[n] == "&", n))
    keys = ", ".join(_sql_text(f"&{n}") for n in names)
    values = ", ".join(_sql_text(html5[n]) for n in names)
    fold = f"list_reduce(list_prepend({expr}, [{keys}]), lambda acc, n: replace(acc, n, (map([{keys}], [{values}]))[n]))"
    return f"regexp_replace({fold}, '  +', ' ', 'g')"


@query("text_fixup", f"select page_id, md5({_sql_fixup('html')}) as fixed_md5 from pages")
def text_fixup(t):
    return t.pages.select("page_id", F.md5(strings.fixup(F.col("html"))).alias("fixed_md5"))


@query(
    "ascii_only",
    r"""select doc_id, length(x) as kept, md5(x) as ascii_md5
        from (select doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') as x from documents)""",
)
def ascii_only(t):
    x = t.documents.select("doc_id", strings.ascii_only(F.col("text")).alias("x"))
    return x.select("doc_id", F.length("x").alias("kept"), F.md5("x").alias("ascii_md5"))


@query("strip_suffix", "select page_id, left(url, length(url) - 2) as link from pages")
def strip_suffix(t):
    return t.pages.select("page_id", strings.strip_version(F.col("url")).alias("link"))


@query(
    "math_ops",
    """select l_orderkey, l_linenumber, l_partkey, abs(l_discount - 0.05) as dev, round(l_extendedprice / 3, 2) as third,
              cast(ceil(l_quantity / 7) as bigint) as packs, round(ln(l_extendedprice), 8) as log_price,
              round(exp(l_tax), 8) as exp_tax, round(sqrt(l_quantity), 8) as root from lineitem""",
)
def math_ops(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.abs(F.col("l_discount") - 0.05).alias("dev"),
        F.round(F.col("l_extendedprice") / 3, 2).alias("third"), F.ceil(F.col("l_quantity") / 7).alias("packs"),
        F.round(F.log("l_extendedprice"), 8).alias("log_price"), F.round(F.exp("l_tax"), 8).alias("exp_tax"),
        F.round(F.sqrt("l_quantity"), 8).alias("root"),
    )


@query(
    "sigmoid_softmax",
    """with s as (select l_orderkey, l_linenumber, l_partkey, 1 / (1 + exp(-l_discount * 10)) as s,
                         exp(l_discount) as a, exp(l_tax) as b, exp(l_quantity / 50) as c from lineitem)
       select l_orderkey, l_linenumber, l_partkey, round(s, 6) as sig, round(s * (1 - s), 6) as slope,
              round(a / (a + b + c), 6) as soft_a, round(c / (a + b + c), 6) as soft_c from s""",
)
def sigmoid_softmax(t):
    x = F.col("l_discount") * 10
    soft = maths.softmax(F.array("l_discount", "l_tax", F.col("l_quantity") / 50))
    df = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(maths.sigmoid(x), 6).alias("sig"),
        F.round(maths.sigmoid_slope(x), 6).alias("slope"), soft.alias("soft"),
    )
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "sig", "slope",
        F.round(F.col("soft")[0], 6).alias("soft_a"), F.round(F.col("soft")[2], 6).alias("soft_c"),
    )


@query(
    "loss_sums",
    """select round(sum(abs(l_quantity / 50 - l_discount * 10)), 2) as l1, round(sum((l_quantity / 50 - l_discount * 10) ** 2), 2) as l2
       from lineitem""",
)
def loss_sums(t):
    y, p = F.col("l_quantity") / 50, F.col("l_discount") * 10
    return t.lineitem.agg(F.round(maths.l1_loss(y, p), 2).alias("l1"), F.round(maths.l2_loss(y, p), 2).alias("l2"))


@query(
    "standardize",
    """with s as (select avg(l_quantity) as m, stddev_pop(l_quantity) as d, avg(l_extendedprice) as pm,
                         stddev_pop(l_extendedprice) as pd from lineitem where l_shipdate < date '1999-01-01')
       select l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / d, 6) as l_quantity_z,
              round((l_extendedprice - pm) / pd, 6) as l_extendedprice_z from lineitem, s""",
)
def standardize(t):
    cols = ["l_quantity", "l_extendedprice"]
    train = t.lineitem.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    z = maths.standardise(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *cols), cols, maths.fit_scale(train, cols))
    return z.drop(*cols).withColumns({f"{c}_z": F.round(f"{c}_z", 6) for c in cols})


@query(
    "pad_sequences",
    """with w as (select item_id, list_transform(string_split(text, ' ')[1:10], lambda x: length(x)) as a from benchmark)
       select item_id, array_to_string(list_concat(a, list_transform(range(greatest(10 - len(a), 0)), lambda x: 0)), ' ') as padded
       from w""",
)
def pad_sequences(t):
    from tidemill.functions.vectors import pad

    sizes = F.transform(F.split("text", " "), F.length)
    return t.benchmark.select("item_id", F.concat_ws(" ", pad(sizes, 10, 0).cast("array<string>")).alias("padded"))


@query("json_field", "select event_id, cast(json_extract(props, '$.k') as bigint) as item from events")
def json_field(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("item"))


@query(
    "json_explode",
    "select event_id, key, cast(json_extract(props, '$.' || key) as bigint) as value "
    "from (select event_id, props, unnest(json_keys(props)) as key from events)",
)
def json_explode(t):
    from tidemill.sources.files import explode_json

    return explode_json(t.events.select("event_id", "props"), "props", "map<string,bigint>")


# ---- U: set operations, upsert ---------------------------------------------


@query(
    "union_files",
    "select o_orderkey, o_totalprice from orders",
)
def union_files(t):
    cols = t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice")
    statuses = [r[0] for r in cols.select("o_orderstatus").distinct().collect()]  # one per file of the original
    frames = [cols.where(F.col("o_orderstatus").eqNullSafe(F.lit(s))).drop("o_orderstatus") for s in statuses]
    return U.union_all(frames)


@query("append_distinct", "select c_nationkey as nationkey from customer union select s_nationkey from supplier")
def append_distinct(t):
    return U.append_distinct(
        t.customer.select(F.col("c_nationkey").alias("nationkey")), t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    )


@query("set_diff", "select c_custkey as custkey from customer except select o_custkey from orders where o_orderstatus = 'F'")
def set_diff(t):
    return U.set_diff(
        t.customer.select(F.col("c_custkey").alias("custkey")),
        t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey")),
    )


@query("distinct_rows", "select distinct o_custkey, o_orderstatus from orders")
def distinct_rows(t):
    return P.distinct_cols(t.orders, ["o_custkey", "o_orderstatus"])


_UPSERT = """with src as (select o_custkey as k, o_orderpriority as v, row_number() over (partition by o_custkey
                  order by o_orderdate desc, o_orderkey desc) as rn from orders where o_orderstatus <> 'P'),
             s as (select k, v from src where rn = 1),
             tgt as (select c_custkey as k, c_mktsegment as v from customer where c_acctbal > 0)"""


def _upsert_sides(t):
    target = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    source = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), "o_orderdate", "o_orderkey"
    )
    return target, source, [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query("upsert_keep", _UPSERT + " select k, v from tgt union all select k, v from s where k not in (select k from tgt)")
def upsert_keep(t):
    target, source, order = _upsert_sides(t)
    return U.upsert(target, source, ["k"], "keep_existing", order)


@query("upsert_replace", _UPSERT + " select k, v from s union all select k, v from tgt where k not in (select k from s)")
def upsert_replace(t):
    target, source, order = _upsert_sides(t)
    return U.upsert(target, source, ["k"], "replace", order)


# ---- J: joins ---------------------------------------------------------------


@query(
    "fact_inner",
    """select l_orderkey, l_linenumber, l_partkey, p_name, p_type from lineitem join part
       on l_partkey = p_partkey and l_quantity = p_size and l_suppkey = p_partkey % 10""",
)
def fact_inner(t):
    p = t.part.select("p_partkey", "p_name", "p_type", F.col("p_size").cast("double").alias("p_len"), (F.col("p_partkey") % 10).alias("p_maker"))
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    df = J.join_on(l, p, [("l_partkey", "p_partkey"), ("l_quantity", "p_len"), ("l_suppkey", "p_maker")])
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_type")


@query(
    "fact_left",
    """select l_orderkey, l_linenumber, l_partkey, p_partkey, p_name from lineitem left join part
       on l_partkey = p_partkey and l_linenumber = p_size % 7 + 1
          and cast(l_extendedprice / 1000 as decimal(18,0)) >= 0
          and cast(round(l_quantity / 10) as decimal(18,0)) = cast(round(p_size / 10.0) as decimal(18,0))""",
)
def fact_left(t):
    p = t.part.select("p_partkey", "p_name", (F.col("p_size") % 7 + 1).alias("p_line"), (F.col("p_size") / 10).alias("p_len"))
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 10).alias("len"))
    df = J.join_rounded(l, p, [("l_partkey", "p_partkey"), ("l_linenumber", "p_line")], ("len", "p_len"), 0, "left")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "p_partkey", "p_name")


@query(
    "insert_new",
    """select distinct c_custkey as user_id, c_name as name from customer
       where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')""",
)
def insert_new(t):
    source = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")).distinct()
    users = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("user_id"))
    return J.only_new(source, users, ["user_id"])


@query(
    "song_lookup",
    """select l_orderkey, l_linenumber, p_partkey, s_suppkey, p_name, s_name from lineitem
       join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
       where p_type = 'ECONOMY' and p_brand = 'Brand#2' and l_quantity between 10 and 30""",
)
def song_lookup(t):
    l = t.lineitem.where(F.col("l_quantity").between(10, 30))
    p = t.part.where("p_type = 'ECONOMY' and p_brand = 'Brand#2'")
    df = J.join_on(J.join_on(l, p, [("l_partkey", "p_partkey")]), t.supplier, [("l_suppkey", "s_suppkey")])
    return df.select("l_orderkey", "l_linenumber", "p_partkey", "s_suppkey", "p_name", "s_name")


@query(
    "shifted_date_join",
    """with o as (select o_orderdate::date + interval 24 month as d, count(*) as orders from orders group by 1),
            l as (select l_shipdate::date as d, count(*) as lines from lineitem group by 1)
       select strftime(l.d, '%Y-%m-%d') as day, lines, sum(orders)::bigint as orders from l join o on l.d = o.d group by 1, 2""",
)
def shifted_date_join(t):
    o = t.orders.groupBy(F.add_months(F.col("o_orderdate").cast("date"), 24).alias("od")).agg(F.count(F.lit(1)).alias("orders"))
    l = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("ld")).agg(F.count(F.lit(1)).alias("lines"))
    return J.join_on(l, o, [("ld", "od")]).select(day("ld").alias("day"), "lines", "orders")


_REFUND = "(select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as refund from lineitem where l_returnflag = 'R' group by l_orderkey)"


def _refunds(t):
    return t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("refund"))


@query(
    "merge_indicator",
    f"""with o as (select o_orderkey, o_totalprice from orders where o_orderstatus <> 'P')
        select o_orderkey, l_orderkey, cast(refund as double) as refund,
               case when l_orderkey is null then 'left_only' when o_orderkey is null then 'right_only' else 'both' end as _merge
        from o full outer join {_REFUND} r on o_orderkey = l_orderkey""",
)
def merge_indicator(t):
    o = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey")
    df = J.merge_indicator(o, _refunds(t), [("o_orderkey", "l_orderkey")])
    return df.withColumn("refund", F.col("refund").cast("double"))


@query(
    "join_suffix",
    """select o_custkey as key, o_totalprice as amount, o_orderkey, c_acctbal as amount_y
       from orders left join customer on o_custkey = c_custkey""",
)
def join_suffix(t):
    o = t.orders.select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount"), "o_orderkey")
    c = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    return J.join_suffix(o, c, ["key"])


@query(
    "enrich_chain",
    """with j as (select o_orderkey, c_custkey, n_nationkey from lineitem
          left join (select * from orders where o_orderstatus <> 'P') o on l_orderkey = o_orderkey
          left join (select * from customer where c_acctbal > 0) c on o_custkey = c_custkey
          left join (select * from nation where n_regionkey <> 0) n on c_nationkey = n_nationkey)
       select 'o_orderkey' as step, count(*) filter (where o_orderkey is null) as unmatched from j
       union all select 'c_custkey', count(*) filter (where c_custkey is null) from j
       union all select 'n_nationkey', count(*) filter (where n_nationkey is null) from j""",
)
def enrich_chain(t):
    steps = [
        (t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey"), [("l_orderkey", "o_orderkey")], "o_orderkey"),
        (t.customer.where("c_acctbal > 0").select("c_custkey", "c_nationkey"), [("o_custkey", "c_custkey")], "c_custkey"),
        (t.nation.where("n_regionkey <> 0").select("n_nationkey", "n_name"), [("c_nationkey", "n_nationkey")], "n_nationkey"),
    ]
    return J.enrich(t.lineitem.select("l_orderkey", "l_linenumber"), steps)[1]


@query(
    "snowflake",
    """select r_name, n_name, count(*) as orders, sum(lines)::bigint as lines, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
       from orders left join (select l_orderkey, count(*) as lines from lineitem group by 1) l on o_orderkey = l_orderkey
       left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
       left join region on n_regionkey = r_regionkey group by r_name, n_name""",
)
def snowflake(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    per_order = J.join_on(t.orders, lines, [("o_orderkey", "l_orderkey")], "left")
    per_cust = per_order.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("lines").alias("lines"), F.sum(cents("o_totalprice")).alias("total")
    )
    df = J.join_on(per_cust, t.customer, [("o_custkey", "c_custkey")], "left")
    df = J.join_on(df, t.nation, [("c_nationkey", "n_nationkey")], "left")
    df = J.join_on(df, t.region, [("n_regionkey", "r_regionkey")], "left")
    return df.groupBy("r_name", "n_name").agg(
        F.sum("orders").alias("orders"), F.sum("lines").alias("lines"), F.sum("total").cast("double").alias("total")
    )


@query(
    "trim_key_join",
    "select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey",
)
def trim_key_join(t):
    c = t.customer.withColumn("ref", F.concat(F.lit("  NATION_"), F.col("c_nationkey").cast("string"), F.lit(" ")))
    n = t.nation.withColumn("ref_n", F.lower(F.col("n_name")))
    return J.join_normalised(c, n, F.upper(F.trim("ref")), F.upper("ref_n")).select("c_custkey", "n_name")


@query(
    "right_join",
    """select c_custkey, o_orderkey from (select * from orders where o_orderstatus = 'F') o
       right join customer on o_custkey = c_custkey""",
)
def right_join(t):
    o = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return J.join_on(o, t.customer.select("c_custkey"), [("o_custkey", "c_custkey")], "right").select("c_custkey", "o_orderkey")


@query(
    "amount_match",
    """select o_orderkey, cast(total as double) as total from orders join
       (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as total from lineitem group by 1) l
       on o_orderkey = l_orderkey and cast(o_totalprice / 1000 as decimal(18,0)) = cast(total / 1000 as decimal(18,0))""",
)
def amount_match(t):
    l = t.lineitem.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("total"))
    l = l.withColumn("l_thousands", F.col("total").cast("double") / 1000)
    o = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("o_thousands"))
    df = J.match_amount(o, l, ("o_orderkey", "l_orderkey"), ("o_thousands", "l_thousands"), scale=0)
    return df.select("o_orderkey", F.col("total").cast("double").alias("total"))


@query(
    "top_user_item",
    """with r as (select o_custkey as u, l_partkey as i, l_quantity as q from orders join lineitem on o_orderkey = l_orderkey),
            tu as (select u from r group by u order by count(*) desc, u limit 15),
            ti as (select i from r group by i order by count(*) desc, i limit 15)
       select u, i, q from r where u in (select u from tu) and i in (select i from ti)""",
)
def top_user_item(t):
    o, l = t.orders.select("o_orderkey", "o_custkey"), t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    r = J.join_on(o, l, [("o_orderkey", "l_orderkey")]).select(
        F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), F.col("l_quantity").alias("q")
    )
    items = J.top_groups(r, "i", 15).select("i")  # of all rows, not of the top users' only
    return J.semi_top(r, "u", 15).join(F.broadcast(items), "i", "left_semi")


@query(
    "fact_dim_peek",
    """select l_orderkey, l_linenumber, p_partkey, p_name from lineitem, part where l_partkey = p_partkey
       order by l_orderkey, l_linenumber, p_partkey, l_suppkey limit 5""",
)
def fact_dim_peek(t):
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    df = J.join_on(l, t.part.select("p_partkey", "p_name"), [("l_partkey", "p_partkey")])
    top = P.preview(df, 5, [F.col(c) for c in ("l_orderkey", "l_linenumber", "p_partkey", "l_suppkey")])
    return top.select("l_orderkey", "l_linenumber", "p_partkey", "p_name")


@query(
    "join_checks",
    """select 'line_order' as "check", count(*) as matched from lineitem where l_orderkey in (select o_orderkey from orders)
       union all select 'order_customer', count(*) from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)
       union all select 'line_part', count(*) from lineitem where l_partkey in (select p_partkey from part where p_size > 10)""",
)
def join_checks(t):
    return U.union_all([
        J.match_count("line_order", t.lineitem, t.orders, [("l_orderkey", "o_orderkey")]),
        J.match_count("order_customer", t.orders, t.customer.where("c_acctbal > 0"), [("o_custkey", "c_custkey")]),
        J.match_count("line_part", t.lineitem, t.part.where("p_size > 10"), [("l_partkey", "p_partkey")]),
    ])


@query(
    "skip_seen",
    """select event_id, user_id from events where user_id not in
       (select user_id from events where event_type = 'signup' and ts < timestamp '2024-01-05 00:00:00')""",
)
def skip_seen(t):
    seen = t.events.where("event_type = 'signup' and ts < timestamp_ntz'2024-01-05 00:00:00'").select("user_id").distinct()
    return J.only_new(t.events.select("event_id", "user_id"), seen, ["user_id"])


@query(
    "dict_lookup",
    """select c_custkey, coalesce(n_name, 'unknown') as nation from customer
       left join (select * from nation where n_regionkey < 3) on c_nationkey = n_nationkey""",
)
def dict_lookup(t):
    d = t.nation.where("n_regionkey < 3")
    return J.lookup(t.customer, "c_nationkey", d, "n_nationkey", "n_name", "unknown", "nation").select("c_custkey", "nation")


@query(
    "sales_grid",
    """with f as (select strftime(l_shipdate, '%Y-%m') as m, s_nationkey as shop, p_brand as item, l_quantity as q
                  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
            s as (select m, shop, item, sum(q) as target from f group by 1, 2, 3),
            a as (select distinct m, shop from s), b as (select distinct m, item from s)
       select a.m as month, a.shop, b.item, coalesce(s.target, 0) as target from a join b on a.m = b.m
       left join s on s.m = a.m and s.shop = a.shop and s.item = b.item""",
)
def sales_grid(t):
    f = J.join_on(t.lineitem, t.supplier, [("l_suppkey", "s_suppkey")])
    f = J.join_on(f, t.part, [("l_partkey", "p_partkey")]).select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("s_nationkey").alias("shop"),
        F.col("p_brand").alias("item"), "l_quantity",
    )
    return J.block_grid(f, "month", "shop", "item", F.sum("l_quantity"), "target")


@query(
    "item_grid",
    """with f as (select strftime(l_shipdate, '%Y-%m') as m, l_suppkey as shop, l_partkey as item, l_quantity as q from lineitem
                  where l_shipdate >= date '1998-09-01' and l_shipdate < date '1998-11-01'),
            s as (select m, shop, item, sum(q) as target from f group by 1, 2, 3),
            a as (select distinct m, shop from s), b as (select distinct m, item from s)
       select a.m as month, a.shop, b.item, coalesce(s.target, 0) as target from a join b on a.m = b.m
       left join s on s.m = a.m and s.shop = a.shop and s.item = b.item""",
)
def item_grid(t):
    """Every shop and item of two months, with what was sold."""
    l = t.lineitem.where("l_shipdate >= date '1998-09-01' and l_shipdate < date '1998-11-01'")
    f = l.select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_suppkey").alias("shop"), F.col("l_partkey").alias("item"), "l_quantity")
    return J.block_grid(f, "month", "shop", "item", F.sum("l_quantity"), "target")


@query(
    "pair_leak",
    """with e as (select distinct o_custkey * 3 as n, l_partkey * 3 + 1 as p from orders join lineitem on o_orderkey = l_orderkey
                  union select distinct l_suppkey * 3 + 2, l_partkey * 3 + 1 from lineitem),
            pr as (select distinct o_custkey * 3 as a, l_suppkey * 3 + 2 as b from orders join lineitem on o_orderkey = l_orderkey),
            c as (select pr.a, pr.b, count(*) as common from pr join e x on x.n = pr.a join e y on y.n = pr.b and y.p = x.p group by 1, 2)
       select a, b, common, common > 3 as leak from c""",
)
def pair_leak(t):
    """Customers, parts and suppliers are the nodes (ids 3k, 3k + 1, 3k + 2); a customer
    and a supplier who share many parts are suspected to leak."""
    o, l = t.orders.select("o_orderkey", "o_custkey"), t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    c, p, s = F.col("o_custkey") * 3, F.col("l_partkey") * 3 + 1, F.col("l_suppkey") * 3 + 2
    ol = materialise(J.join_on(o, l, [("o_orderkey", "l_orderkey")]).select("o_custkey", "l_partkey", "l_suppkey"))
    edges = ol.select(c.alias("src"), p.alias("dst")).union(l.select(s, p))
    df = J.common_neighbours(edges, ol.select(c.alias("a"), s.alias("b")))
    return df.withColumn("leak", F.col("common") > 3)


@query(
    "id_lookup",
    "select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')",
)
def id_lookup(t):
    from tidemill.sources.files import lookup_ids

    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return lookup_ids(t.orders.select("o_orderkey", "o_orderstatus"), ids, "o_orderkey")


@query(
    "date_windows",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders
       where o_orderdate >= date '1996-01-01' and o_orderdate <= date '1998-12-31'""",
)
def date_windows(t):
    from tidemill.sources.files import between_dates

    return between_dates(t.orders, "o_orderdate", "1996-01-01", "1998-12-31").select("o_orderkey", day("o_orderdate").alias("day"))


@query(
    "id_newest",
    """select user_id, event_id, value from (select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events)
       where rn = 1""",
)
def id_newest(t):
    return top_per_key(t.events, ["user_id"], [F.desc("ts"), F.col("event_id")]).select("user_id", "event_id", "value")
