"""Queries for sources, sinks, quality checks, end-to-end jobs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import dates
from tidemill.operators import quality as Q
from tidemill.operators import relational as P
from tidemill.operators.joins import join_on
from tidemill.operators.loads import load, union_all
from tidemill.plans import reconciliation as R
from tidemill.plans import star, store_sales
from tidemill.plans.q_relational import day
from tidemill.plans.registry import query
from tidemill.session import TABLES, materialise, scratch_dir
from tidemill.sources import files, ledger, sinks
from tidemill.streaming import jobs

# ---- sources and sinks -----------------------------------------------------------


@query(
    "combine_logs",
    """select event_id, user_id, value, event_type from events where event_type <> 'error'""",
)
def combine_logs(t):
    log = t.events.withColumn("artist", F.when(F.col("event_type") != "error", F.col("event_type")).otherwise(""))
    return files.combine_logs(log, ["event_id", "user_id", "value", "event_type"], "artist")


_EVENTS = "event_id bigint, user_id bigint, event_type string, value double, item bigint"


@query(
    "stage_events",
    "select event_id, user_id, event_type, value, cast(json_extract(props, '$.k') as bigint) as item from events",
)
def stage_events(t):
    raw, table = scratch_dir(t.spark, "raw"), scratch_dir(t.spark, "staging")
    item = F.get_json_object("props", "$.k").cast("bigint").alias("item")
    t.events.select("event_id", "user_id", "event_type", "value", item).write.json(raw)
    sinks.stage(t.spark, raw, "json", _EVENTS, table)
    return sinks.stage(t.spark, raw, "json", _EVENTS, table)  # a second load replaces the first


@query(
    "loose_headers",
    """select o_orderkey::varchar as "ORDER INFO", 'A' || o_orderkey as "ARN",
              strftime(o_orderdate, '%Y-%m-%d') as "TXN DATE", o_custkey::varchar as "TXN AMOUNT" from orders""",
)
def loose_headers(t):
    canonical = ["ORDER INFO", "ARN", "TXN DATE", "TXN AMOUNT"]
    cols = [F.col("o_orderkey"), F.concat(F.lit("A"), F.col("o_orderkey")), day("o_orderdate"), F.col("o_custkey")]
    odd, even = scratch_dir(t.spark, "odd"), scratch_dir(t.spark, "even")
    rows = t.orders
    first = rows.where("o_orderkey % 2 = 1").select(*cols).toDF("order info", " Arn", "TXN  DATE", "TxnAmount ")
    second = rows.where("o_orderkey % 2 = 0").select(*reversed(cols)).toDF("txn amount", "TXN DATE", "ARN", "Order Info")
    sinks.write_csv(first, odd)
    sinks.write_csv(second, even)
    good, _ = files.read_loose(t.spark, [odd, even], canonical)
    return good.select(*canonical)


@query(
    "incremental_load",
    "select event_id, user_id, value from events",
)
def incremental_load(t):
    """Three deliveries into one folder, a load after each; deliveries repeat rows of earlier ones."""
    inbox, store, book = (scratch_dir(t.spark, n) for n in ("inbox", "history", "ledger"))
    e = t.events.select("event_id", "user_id", "value")
    e.limit(0).write.parquet(store)
    t.spark.createDataFrame([], "path string").write.parquet(book)
    for upto in range(3):
        e.where(F.pmod("event_id", F.lit(3)) <= upto).write.json(f"{inbox}/delivery-{upto}")
        history, known = t.spark.read.parquet(store), t.spark.read.parquet(book)
        rows, entered = ledger.load_folder(
            t.spark, inbox, lambda paths: files.read_json(t.spark, paths, e.schema), known, history, ["event_id"], "*.json"
        )
        rows.write.mode("append").parquet(store)
        entered.write.mode("append").parquet(book)
    return t.spark.read.parquet(store)


@query(
    "partitioned_roundtrip",
    """select o_orderstatus, year(o_orderdate)::int as year, count(*) as n from orders where year(o_orderdate) >= 1998 group by 1, 2""",
)
def partitioned_roundtrip(t):
    out = scratch_dir(t.spark, "orders")
    sinks.write_table(t.orders.withColumn("year", F.year("o_orderdate")), out, ["year", "o_orderstatus"])
    back = t.spark.read.parquet(out).where("year >= 1998")
    return back.groupBy("o_orderstatus", "year").agg(F.count(F.lit(1)).alias("n"))


@query(
    "load_modes",
    """select 'truncate_insert' as mode, count(*) as n from customer union all select 'append', 2 * count(*) from customer""",
)
def load_modes(t):
    frames = []
    for mode in ("truncate_insert", "append"):
        out = scratch_dir(t.spark, mode)
        load(t.customer, out, mode)
        load(t.customer, out, mode)
        frames.append(t.spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("mode"), "n"))
    return union_all(frames)


def _log(t):
    """Events as a listening log: 20 users a session, items by the JSON field."""
    return t.events.select(
        F.expr("user_id div 20").alias("session"), "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        F.col("event_type").alias("song"), "value", "ts", "event_id",
    )


_LOG = """l as (select user_id // 20 as session, user_id, cast(json_extract(props, '$.k') as bigint) as item, event_type as song, value, ts, event_id
          from events)"""


def _newest():
    return [F.desc("ts"), F.desc("event_id")]


@query(
    "q_session_item",
    f"""with {_LOG}, r as (select *, row_number() over (partition by session, item order by ts desc, event_id desc) as rn from l)
        select session, item, song, value from r where rn = 1 and session = 3 and item between 10 and 40""",
)
def q_session_item(t):
    copy = sinks.keyed_copy(_log(t), ["session"], ["item"], _newest())
    return P.keep(copy, (F.col("session") == 3) & F.col("item").between(10, 40)).select("session", "item", "song", "value")


@query(
    "q_user_session",
    f"""with {_LOG}, r as (select *, row_number() over (partition by user_id, session, item order by ts desc, event_id desc) as rn from l)
        select user_id, session, item, song from r where rn = 1 and user_id = 10""",
)
def q_user_session(t):
    copy = sinks.keyed_copy(_log(t), ["user_id", "session"], ["item"], _newest())
    return P.keep(copy, F.col("user_id") == 10).select("user_id", "session", "item", "song")


@query(
    "q_song_users",
    "select distinct event_type as song, user_id from events where event_type = 'purchase'",
)
def q_song_users(t):
    copy = sinks.keyed_copy(_log(t), ["song"], ["user_id"], _newest())
    return P.keep(copy, F.col("song") == "purchase").select("song", "user_id")


# ---- quality ---------------------------------------------------------------------


@query(
    "dq_nonempty",
    " union all ".join(
        f"select 'nonempty_{n}' as \"check\", count(*) > 0 as passed, count(*) as actual, 1 as expected from {n}" for n in TABLES
    ),
)
def dq_nonempty(t):
    return Q.check_nonempty({n: getattr(t, n) for n in TABLES})


@query(
    "dq_expected",
    """select 'big_parts' as "check", count(*) = 28 as passed, count(*) as actual, 28 as expected from part where p_size > 25""",
)
def dq_expected(t):
    return Q.check_expected("big_parts", t.part.where("p_size > 25").agg(F.count(F.lit(1)).alias("n")), 28)


@query(
    "dq_unique",
    """select 'order_key' as "check", count(*) = 0 as passed, count(*) as actual, 0 as expected
       from (select o_orderkey from orders group by 1 having count(*) > 1)
       union all select 'line_key', count(*) = 0, count(*), 0 from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)""",
)
def dq_unique(t):
    return Q.combine([
        Q.check_unique("order_key", t.orders, ["o_orderkey"]),
        Q.check_unique("line_key", t.lineitem, ["l_orderkey", "l_linenumber"]),
    ])


@query(
    "dq_profile",
    " union all ".join(f"select '{n}' as table_name, (select count(*) from (describe {n})) as n_columns, count(*) as n from {n}" for n in TABLES),
)
def dq_profile(t):
    return Q.table_shape({n: getattr(t, n) for n in TABLES})


# ---- star schema -------------------------------------------------------------------


def staging(t):
    """The test tables as the two staging tables of the star schema."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    l = join_on(join_on(t.lineitem, o, [("l_orderkey", "o_orderkey")]), c, [("o_custkey", "c_custkey")])
    events = l.select(
        F.concat(F.lit("song-"), F.col("l_partkey").cast("string")).alias("song"),
        F.concat(F.lit("artist-"), (F.col("l_suppkey") % 10).cast("string")).alias("artist"),
        (F.col("l_quantity") % 5).alias("length"),
        F.when(F.col("l_returnflag") == "A", "Home").otherwise("NextSong").alias("page"),
        dates.to_epoch_ms(F.col("l_shipdate")).alias("ts"),
        F.col("l_orderkey").alias("sessionid"), F.col("o_custkey").alias("userid"), F.col("c_name").alias("firstname"),
        F.col("c_mktsegment").alias("level"), F.col("c_nationkey").alias("location"), F.col("l_linestatus").alias("useragent"),
    )
    songs = t.part.select(
        F.col("p_partkey").alias("song_id"), F.concat(F.lit("song-"), F.col("p_partkey").cast("string")).alias("title"),
        (F.col("p_partkey") % 10).alias("artist_id"),
        F.concat(F.lit("artist-"), (F.col("p_partkey") % 10).cast("string")).alias("artist_name"),
        F.col("p_brand").alias("artist_location"), (F.col("p_size") % 5).cast("double").alias("duration"),
        (F.col("p_size") + 1975).alias("year"),
    )
    return events, songs


_STAR = """ev as (select 'song-' || l_partkey as song, 'artist-' || (l_suppkey % 10) as artist, l_quantity % 5 as length, l_shipdate as start_time,
              l_orderkey as sessionid, o_custkey as userid, c_name as firstname, c_mktsegment as level, c_nationkey as location,
              l_linestatus as useragent, l_partkey
         from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where l_returnflag <> 'A'),
    sg as (select p_partkey as song_id, 'song-' || p_partkey as title, p_partkey % 10 as artist_id, 'artist-' || (p_partkey % 10) as artist_name,
              p_brand as artist_location, (p_size % 5)::double as duration, p_size + 1975 as year, p_type from part),
    fact as (select distinct md5(sessionid::varchar || strftime(start_time, '%Y-%m-%d %H:%M:%S')) as playid, start_time, userid, level, song_id, artist_id,
              sessionid, location, useragent from ev left join sg on song = title and artist = artist_name and length = duration)"""


@query(
    "star_schema",
    f"""with {_STAR} select year(start_time) as year, month(start_time) as month, coalesce(p_type, 'unknown') as part_type,
           count(*) as plays, count(distinct userid) as listeners from fact left join part on song_id = p_partkey group by 1, 2, 3""",
)
def star_schema(t):
    s = star.star_schema(*staging(t))
    typed = s["songplays"].join(t.part.select(F.col("p_partkey").alias("song_id"), "p_type"), "song_id", "left")
    timed = typed.join(s["time"].select("start_time", "year", "month"), "start_time")
    per_user = timed.groupBy("year", "month", F.coalesce("p_type", F.lit("unknown")).alias("part_type"), "userid").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("year", "month", "part_type").agg(F.sum("n").alias("plays"), F.count(F.lit(1)).alias("listeners"))


@query(
    "star_songplays",
    f"""with {_STAR} select playid, strftime(start_time, '%Y-%m-%d') as start_time, userid, level, coalesce(song_id, -1) as song_id,
           coalesce(artist_id, -1) as artist_id, sessionid, location, useragent from fact""",
)
def star_songplays(t):
    f = star.songplays(*staging(t)).withColumn("start_time", day("start_time"))
    return f.fillna(-1, ["song_id", "artist_id"])


@query("star_users", f"with {_STAR} select distinct userid, firstname, level from ev")
def star_users(t):
    return star.users(staging(t)[0])


@query(
    "star_time",
    f"""with {_STAR} select distinct strftime(start_time, '%Y-%m-%d') as start_time, hour(start_time) as hour, day(start_time) as day,
            weekofyear(start_time) as week, month(start_time) as month, year(start_time) as year, dayofweek(start_time) as weekday from ev""",
)
def star_time(t):
    return star.star_schema(*staging(t))["time"].withColumn("start_time", day("start_time"))


@query("star_artists", f"with {_STAR} select distinct artist_id, artist_name, artist_location from sg")
def star_artists(t):
    return star.artists(staging(t)[1])


@query(
    "star_checks",
    f"""with {_STAR}, c as (select 'songplays' as n, (select count(*) from fact) as k union all select 'users', (select count(*) from (select distinct userid, firstname, level from ev))
        union all select 'songs', (select count(*) from sg) union all select 'artists', (select count(*) from (select distinct artist_id, artist_name, artist_location from sg))
        union all select 'time', (select count(distinct start_time) from ev))
        select 'nonempty_' || n as "check", k > 0 as passed, k as actual, 1 as expected from c
        union all select 'unique_playid', count(*) = 0, count(*), 0 from (select playid from fact group by 1 having count(*) > 1)""",
)
def star_checks(t):
    return star.star_checks(star.star_schema(*staging(t)))


_TOUR = """f as (select l_returnflag as citizenship, l_linestatus as mode, l_linenumber::varchar as address, l_tax as visa, l_suppkey as port,
    strftime(l_shipdate, '%Y-%m-%d') as arrival, count(*) as passengers from lineitem
    where l_linestatus = 'F' and l_tax = 0.02 and l_returnflag not in ('R') and l_linenumber in (1, 2, 3, 4) group by all)"""


def _tourism(t):
    sas = F.datediff("l_shipdate", F.lit("1960-01-01").cast("date")).cast("double")
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("citizenship"), F.col("l_linestatus").alias("mode"), F.col("l_linenumber").cast("string").alias("address"),
        F.col("l_tax").alias("visa"), F.col("l_suppkey").alias("port"), sas.alias("arrival"), F.col("l_orderkey").alias("id"),
        F.year("l_shipdate").alias("file"),
    )
    one_per_file = [rows.where("file < 1998").drop("file"), rows.where("file >= 1998").drop("file")]
    return star.tourism(one_per_file, "F", 0.02, exclude=["R"], include=["1", "2", "3", "4"])


@query("tourism_fact", f"with {_TOUR} select * from f")
def tourism_fact(t):
    return _tourism(t)["fact"].withColumn("arrival", day("arrival"))


@query(
    "tourism_job",
    f"""with {_TOUR} select arrival[1:4]::int as year, arrival[6:7]::int as month, count(distinct arrival) as days, sum(passengers)::bigint as passengers
        from f group by 1, 2""",
)
def tourism_job(t):
    out = _tourism(t)
    per_day = out["fact"].groupBy("arrival").agg(F.sum("passengers").alias("passengers"))
    joined = per_day.join(out["time"], "arrival")
    return joined.groupBy("year", "month").agg(F.count(F.lit(1)).alias("days"), F.sum("passengers").alias("passengers"))


# ---- reconciliation ------------------------------------------------------------------


def payments(t):
    """Refunds and settlements bound to the order lines; some lines settle late or otherwise."""
    l = t.lineitem
    refunds = l.select(
        F.col("l_orderkey").alias("order_number"), F.col("l_partkey").alias("return_id"), F.col("l_suppkey").alias("pps_id"),
        F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("attempted"),
        F.when(F.col("l_returnflag") == "R", "SUCCESS").when(F.col("l_returnflag") == "A", "FAILED").otherwise("PENDING").alias("status"),
    )
    seen = l.where("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("order_info"), F.concat(F.lit("ARN"), F.col("l_partkey").cast("string")).alias("arn"),
        F.col("l_shipdate").alias("txn_date"), F.date_add("l_shipdate", 3).alias("settlement_date"),
        F.when(F.col("l_linenumber") == 7, F.col("l_extendedprice") * 2).otherwise(F.col("l_extendedprice")).alias("txn_amount"),
    )
    return refunds, seen


_PAY = """rf0 as (select l_orderkey as o, l_partkey as ret, l_suppkey as pps, abs(cast(l_extendedprice as decimal(18,2))) as amount, l_shipdate as attempted,
            case l_returnflag when 'R' then 'SUCCESS' when 'A' then 'FAILED' else 'PENDING' end as status from lineitem),
    rf as (select * from (select *, row_number() over (partition by o, ret, pps, amount order by attempted desc, status) as rn from rf0) where rn = 1),
    st as (select distinct l_orderkey as o, 'ARN' || l_partkey as arn, l_shipdate as txn_date, l_shipdate::date + 3 as settlement_date,
            abs(cast(case when l_linenumber = 7 then l_extendedprice * 2 else l_extendedprice end as decimal(18,2))) as amount
           from lineitem where l_linestatus = 'F'),
    k as (select distinct o, amount from st),
    mk as (select rf.*, k.o is not null as paid from rf left join k on rf.o = k.o and rf.amount = k.amount),
    iso as (select * from st where (o, amount) not in (select (o, amount) from rf)),
    ra as (select o, amount, count(*) as n from rf group by 1, 2 having count(*) > 1),
    sa as (select o, amount, count(*) as n from st group by 1, 2 having count(*) > 1),
    tot as (select a.o from (select o, sum(amount) as t from rf group by 1) a join (select o, sum(amount) as t from st group by 1) b on a.o = b.o and a.t = b.t),
    rep as (select * from ra where (o, amount, n) not in (select (o, amount, n) from sa) and o not in (select o from tot)),
    sp as (select a.o, refund_sum, refunds, settled_sum from
            (select o, sum(amount) as refund_sum, count(*) as refunds from mk where status <> 'SUCCESS' and not paid group by 1) a
            join (select o, sum(amount) as settled_sum from iso group by 1) b on a.o = b.o where refund_sum > settled_sum)"""


def _sec(name, src, cond="true", amount="cast(sum(amount) as double)"):
    return f"select '{name}' as section, count(*) as n, {amount} as amount from {src} where {cond}"


@query(
    "reconcile",
    f"with {_PAY} "
    + " union all ".join([
        _sec("matched", "mk", "status = 'SUCCESS' and paid"),
        _sec("not_settled", "mk", "status = 'SUCCESS' and not paid"),
        _sec("failed_settled", "mk", "status <> 'SUCCESS' and paid"),
        _sec("failed_open", "mk", "status <> 'SUCCESS' and not paid"),
        _sec("isolated", "iso"),
        _sec("short_paid", "sp", amount="cast(sum(refund_sum) as double)"),
        _sec("repeats", "rep"),
        """select 'missing_days', max(txn_date::date) - min(txn_date::date) + 1 - count(distinct txn_date::date), null from st""",
    ]),
)
def reconcile(t):
    return R.summary(R.reconcile(*payments(t)))


@query(
    "recon_short_paid",
    f"with {_PAY} select o as order_number, cast(refund_sum as double) as refund_sum, refunds, cast(settled_sum as double) as settled_sum from sp",
)
def recon_short_paid(t):
    s = R.reconcile(*payments(t))["short_paid"]
    return s.withColumns({c: F.col(c).cast("double") for c in ("refund_sum", "settled_sum")})


@query(
    "recon_status_days",
    f"""with {_PAY} select strftime(attempted, '%Y-%m-%d') as day, count(*) filter (where status = 'SUCCESS') as SUCCESS,
        count(*) filter (where status = 'FAILED') as FAILED, count(*) filter (where status = 'PENDING') as PENDING from rf group by 1""",
)
def recon_status_days(t):
    r = R.clean_refunds(payments(t)[0])
    return R.status_by_day(r).withColumn("day", day("day"))


@query(
    "fraud_check",
    f"with {_PAY} select o as order_number, arn, cast(amount as double) as amount from st where o not in (select o from rf where status <> 'PENDING')",
)
def fraud_check(t):
    r, s = payments(t)
    r = R.clean_refunds(r).where("status <> 'PENDING'")
    df = R.settled_without_order(R.clean_settlements(s), r)
    return df.select("order_number", "arn", F.col("amount").cast("double").alias("amount"))


@query(
    "declined_settled",
    f"""with {_PAY} select o as order_number, ret as return_id, cast(amount as double) as amount, status from rf where status <> 'SUCCESS'
        and o not in (select o from rf where status = 'SUCCESS') and o in (select o from st)""",
)
def declined_settled(t):
    r, s = payments(t)
    df = R.declined_but_settled(R.clean_refunds(r), R.clean_settlements(s))
    return df.select("order_number", "return_id", F.col("amount").cast("double").alias("amount"), "status")


@query(
    "failure_classes",
    """with f as (select case when o_custkey % 3 = 0 then o_orderkey end as ticket, o_orderstatus, o_orderpriority,
                  case o_orderpriority when '1-URGENT' then 'ticket raised' when '2-HIGH' then 'ticket opened' else 'new' end as state from orders)
       select case when ticket is null and state not in ('ticket raised', 'ticket opened') then 'no_ticket'
                   when ticket is null and state = 'ticket raised' then 'ticket_missing' else 'other' end as class, count(*) as n from f group by 1""",
)
def failure_classes(t):
    state = F.when(F.col("o_orderpriority") == "1-URGENT", "ticket raised").when(F.col("o_orderpriority") == "2-HIGH", "ticket opened").otherwise("new")
    f = t.orders.select(F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderkey")).alias("ticket"), state.alias("state"))
    return R.failure_classes(f).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "notify_list",
    f"""with {_PAY}, skip as (select o from rep union select o from ra union select o from sa),
        kept as (select *, count(*) over (partition by o) as n from mk where status = 'SUCCESS' and paid and o not in (select o from skip))
        select o as order_number, ret as return_id, cast(amount as double) as amount, case when n > 1 then 'multiple' else 'single' end as kind,
               c_name as customer, p_name as product from kept left join orders on o = o_orderkey left join customer on o_custkey = c_custkey
               left join part on ret = p_partkey""",
)
def notify_list(t):
    r, s = payments(t)
    r, s = materialise(R.clean_refunds(r)), materialise(R.clean_settlements(s))
    who = join_on(t.orders, t.customer, [("o_custkey", "c_custkey")]).select(F.col("o_orderkey").alias("contact_order"), F.col("c_name").alias("customer"))
    what = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product"))
    df = R.notify_list(R.split_refunds(R.mark_paid(r, s))["matched"], r, s, who, what)
    return df.select("order_number", "return_id", F.col("amount").cast("double").alias("amount"), "kind", "customer", "product")


# ---- store sales ------------------------------------------------------------------


_STORE = """d as (select l_suppkey as store, l_shipdate::date as day, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sales,
        max((l_returnflag = 'R')::int) as promo from lineitem group by 1, 2),
    x as (select *, last_value(case when promo > 0 then day end ignore nulls) over (partition by store order by day rows between unbounded preceding and current row) as lp,
                 last_value(case when promo > 0 then day end ignore nulls) over (partition by store order by day desc rows between unbounded preceding and current row) as np,
                 sum(promo) over (partition by store order by day rows between 6 preceding and current row) as bw,
                 sum(promo) over (partition by store order by day rows between current row and 6 following) as fw from d),
    s as (select s_suppkey, n_name, case when s_suppkey % 7 = 0 then null else 1988 + s_suppkey % 12 end as oy, s_suppkey % 12 + 1 as om,
                 case when s_suppkey % 5 = 0 then null else 1989 + s_suppkey % 9 end as py, s_suppkey % 50 + 1 as pw
          from supplier left join nation on s_nationkey = n_nationkey),
    y as (select *, case when coalesce(oy, 1900) < 1990 then 0 else greatest(date_diff('day', make_date(oy, om, 15), day), 0) end as cd,
                 case when coalesce(py, 1900) < 1990 then 0 else greatest(date_diff('day',
                    (date_trunc('week', make_date(py, 1, 4)) + to_days(((pw - 1) * 7)::int))::date, day), 0) end as pd
          from x left join s on store = s_suppkey)"""


@query(
    "store_features",
    f"""with {_STORE} select store, strftime(day, '%Y-%m-%d') as day, sales, promo, coalesce(date_diff('day', lp, day), 0) as after_promo,
        coalesce(date_diff('day', np, day), 0) as before_promo, bw::bigint as promo_bw, fw::bigint as promo_fw, n_name as state, cd as competition_days,
        least(cd // 30, 24) as competition_months, least(pd // 7, 25) as promo_weeks, weekofyear(day) as week, dayofyear(day) as dayofyear
        from y where sales <> 0""",
)
def store_features(t):
    sales = F.col("l_extendedprice").cast("decimal(18,2)")
    daily = store_sales.daily_sales(t.lineitem, "l_suppkey", "l_shipdate", sales, {"promo": F.col("l_returnflag") == "R"})
    n = F.col("s_suppkey")
    s = join_on(t.supplier, t.nation, [("s_nationkey", "n_nationkey")], "left").select(
        n.alias("store"), F.col("n_name").alias("state"),
        F.when(n % 7 != 0, 1988 + n % 12).cast("int").alias("open_year"), (n % 12 + 1).cast("int").alias("open_month"),
        F.when(n % 5 != 0, 1989 + n % 9).cast("int").alias("promo_year"), (n % 50 + 1).cast("int").alias("promo_week"),
    )
    f = store_sales.store_features(daily, s, ["promo"])
    return f.select(
        "store", day("day").alias("day"), F.col("sales").cast("double").alias("sales"), "promo",
        F.col("Afterpromo").alias("after_promo"), F.col("Beforepromo").alias("before_promo"), "promo_bw", "promo_fw", "state",
        "competition_days", "competition_months", "promo_weeks", F.col("d_week").alias("week"), F.col("d_dayofyear").alias("dayofyear"),
    )


# ---- streams -----------------------------------------------------------------------


def _event_stream(t):
    return jobs.file_stream(t.spark, t.root, t.events.schema, pattern="events.parquet")


@query("stream_ingest", "select event_id, user_id, event_type, value from events")
def stream_ingest(t):
    out = scratch_dir(t.spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        jobs.ingest_stream(_event_stream(t), out, out + "-cp", ["event_id"], "ts").awaitTermination()
    return t.spark.read.schema(t.events.schema).parquet(out).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_upsert",
    """select user_id, event_id, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
       where rn = 1""",
)
def stream_upsert(t):
    out = scratch_dir(t.spark, "upsert")
    for _ in range(2):
        jobs.upsert_stream(_event_stream(t), out, out + "-cp", ["user_id"], _newest()).awaitTermination()
    return t.spark.read.parquet(out).select("user_id", "event_id", "value")


def _deliveries(t, name: str, parts, run):
    """Write each part of the events into one folder and let ``run`` take what is new."""
    out = scratch_dir(t.spark, name)
    for part in parts:
        part.write.mode("append").parquet(out + "-src")
        run(jobs.file_stream(t.spark, out + "-src", t.events.schema), out).awaitTermination()
    return t.spark.read.parquet(out)


@query("stream_late", "select event_id, user_id, event_type, value from events")
def stream_late(t):
    """The newest events come first; then all of them, most of them late, the first ones again."""
    parts = [t.events.where("ts >= timestamp_ntz '2024-01-20 00:00:00'"), t.events]
    got = _deliveries(t, "late", parts, lambda rows, out: jobs.ingest_stream(rows, out, out + "-cp", ["event_id"], "ts", "5 days"))
    return got.select("event_id", "user_id", "event_type", "value")


@query(
    "stream_upsert_twice",
    """select user_id, event_id, value from (
         select *, row_number() over (partition by user_id order by event_id % 7 <> 0, ts desc, event_id desc) as rn from events) where rn = 1""",
)
def stream_upsert_twice(t):
    """Two deliveries with the same users: what is stored stays, new users come in."""
    parts = [t.events.where("event_id % 7 = 0"), t.events.where("event_id % 7 <> 0")]
    got = _deliveries(t, "twice", parts, lambda rows, out: jobs.upsert_stream(rows, out, out + "-cp", ["user_id"], _newest()))
    return got.select("user_id", "event_id", "value")


@query(
    "stream_star",
    f"""with {_STAR} select 'songplays' as table_name, count(*) as n from fact union all select 'users', count(distinct userid) from ev
        union all select 'time', count(distinct start_time) from ev union all select 'songs', count(distinct song_id) from sg
        union all select 'artists', count(distinct artist_id) from sg""",
)
def stream_star(t):
    out = scratch_dir(t.spark, "star")
    events, songs = staging(t)
    src = out + "-src"
    events.write.parquet(src)
    stream = jobs.file_stream(t.spark, src, events.schema)
    jobs.star_stream(stream, songs, out, out + "-cp").awaitTermination()
    frames = [
        t.spark.read.parquet(f"{out}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
        for n in ("songplays", "users", "time", "songs", "artists")
    ]
    return union_all(frames)
