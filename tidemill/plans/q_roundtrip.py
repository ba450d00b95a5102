"""Queries that write the test tables in a source format and read them back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.registry import query
from tidemill.session import materialise, scratch_dir
from tidemill.sources import files, sinks

_ORDERS = "select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders"
_ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string"
_TEXT = files.text_schema(["o_orderkey", "o_custkey", "o_orderstatus"])
_TEXT_SQL = "select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus from orders"


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def _as_text(t):
    return t.orders.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")


@query("scan_json_tree", _ORDERS + " where o_orderstatus <> 'P'")
def scan_json_tree(t):
    """JSON objects in a folder tree, by glob (S01): the tree of one status is left out."""
    root = scratch_dir(t.spark, "tree")
    for name, kept in (("a/b/open", "o_orderstatus = 'O'"), ("a/c/done", "o_orderstatus not in ('O', 'P')"), ("x/y/part", "o_orderstatus = 'P'")):
        _orders(t).where(kept).write.json(f"{root}/{name}")
    return files.read_json(t.spark, f"{root}/a/*/*/*.json", _ORDER_SCHEMA)


@query("scan_csv_text", _TEXT_SQL)
def scan_csv_text(t):
    """CSV with a header, all columns text."""
    out = scratch_dir(t.spark, "csv")
    sinks.write_csv(_as_text(t), out)
    return files.read_csv(t.spark, out, _TEXT)


@query("scan_csv_semicolon", _TEXT_SQL)
def scan_csv_semicolon(t):
    """CSV with semicolons."""
    out = scratch_dir(t.spark, "csv")
    _as_text(t).write.option("header", True).option("sep", ";").csv(out)
    return files.read_csv(t.spark, out, _TEXT, sep=";")


@query("scan_json_lines", "select event_id, user_id, event_type, value from events")
def scan_json_lines(t):
    """A log of one JSON object a line."""
    out = scratch_dir(t.spark, "log")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(out)
    return files.read_json(t.spark, out, "event_id bigint, user_id bigint, event_type string, value double")


@query("scan_json_whole", "select n_regionkey as region, count(*) as nations, min(n_name) as first_name from nation group by 1")
def scan_json_whole(t):
    """One JSON object a file, spread over lines, as one row."""
    out = scratch_dir(t.spark, "objects")
    parts = t.nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    body = F.to_json(F.struct(F.col("n_regionkey").alias("region"), "names"), {"pretty": "true"}).alias("value")
    parts.select("n_regionkey", body).repartition("n_regionkey").write.partitionBy("n_regionkey").text(out)
    rows = files.read_json(t.spark, out, "region bigint, names array<string>", multiline=True, recursive=True)
    return rows.select("region", F.size("names").cast("bigint").alias("nations"), F.col("names")[0].alias("first_name"))


@query("scan_recursive", "select o_orderkey from orders where o_orderstatus <> 'P'")
def scan_recursive(t):
    """All files of one extension anywhere below a folder."""
    root = scratch_dir(t.spark, "deep")
    keys = t.orders.select("o_orderkey", "o_orderstatus")
    keys.where("o_orderstatus = 'O'").drop("o_orderstatus").write.json(f"{root}/one")
    keys.where("o_orderstatus not in ('O', 'P')").drop("o_orderstatus").write.json(f"{root}/two/three/four")
    keys.where("o_orderstatus = 'P'").drop("o_orderstatus").write.csv(f"{root}/two/other")
    return files.read_json(t.spark, root, "o_orderkey bigint", recursive=True, pattern="*.json")


@query(
    "scan_gzip_csv",
    """select o_orderkey as order_id, cast(o_totalprice as decimal(18,2))::double as amount, strftime(o_orderdate, '%Y-%m-%d') as placed,
              o_orderstatus = 'F' as final from orders""",
)
def scan_gzip_csv(t):
    """Headerless gzip CSV with given names and a converter per column."""
    out = scratch_dir(t.spark, "gz")
    raw = t.orders.select("o_orderkey", F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(18,2)")), F.date_format("o_orderdate", "dd/MM/yyyy"), "o_orderstatus")
    sinks.write_csv(raw, out, gzip=True, header=False)
    back = files.read_csv(t.spark, out, files.text_schema(["order_id", "amount", "placed", "status"]), header=False)
    return back.select(
        F.col("order_id").cast("bigint").alias("order_id"), F.substring("amount", 2, 40).cast("double").alias("amount"),
        F.date_format(F.to_date("placed", "dd/MM/yyyy"), "yyyy-MM-dd").alias("placed"), (F.col("status") == "F").alias("final"),
    )


@query(
    "quarantine",
    """select 'good' as part, count(*) as n from events where event_type <> 'error'
       union all select 'broken', count(*) from events where event_type = 'error'""",
)
def quarantine(t):
    """Broken lines go to a table of their own and are not lost (S11): error events are cut in the middle."""
    out = scratch_dir(t.spark, "mixed")
    line = F.to_json(F.struct("event_id", "value"))
    t.events.select(F.when(F.col("event_type") == "error", F.substring(line, 1, 8)).otherwise(line)).write.text(out)
    schema = T.StructType.fromDDL("event_id bigint, value double")
    good, broken = files.read_checked(t.spark, out, schema)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(good, "good").unionByName(count(broken, "broken"))


@query("labelled_text", "select 'q' || quality as label, md5(text) as text_md5 from labels join documents using (doc_id)")
def labelled_text(t):
    """A folder tree whose folder names are labels, one text a file."""
    root = scratch_dir(t.spark, "texts")
    rows = t.labels.join(t.documents, "doc_id").select(F.concat(F.lit("q"), "quality").alias("label"), "doc_id", "text")
    rows = materialise(rows)
    for label in [r[0] for r in rows.select("label").distinct().collect()]:
        sinks.write_texts(rows.where(F.col("label") == label), "doc_id", "text", f"{root}/{label}")
    back = files.read_labelled_text(t.spark, root)
    return back.select("label", F.md5(F.regexp_replace("text", "\u0000$", "")).alias("text_md5"))


@query("source_column", "select o_orderstatus || '.csv' as file, count(*) as n from orders group by 1")
def source_column(t):
    """CSVs put together with the name of the folder each row came from."""
    root = scratch_dir(t.spark, "named")
    for status in [r[0] for r in t.orders.select("o_orderstatus").distinct().collect()]:
        sinks.write_csv(t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey"), f"{root}/{status}.csv")
    rows = files.with_source_file(files.read_csv(t.spark, root, "o_orderkey bigint", recursive=True), "name", folder=True)
    return rows.groupBy(F.col("name").alias("file")).agg(F.count(F.lit(1)).alias("n"))


@query("parallel_lines", "select row_number() over (order by c_custkey) - 1 as line, c_name as a, c_mktsegment as b from customer")
def parallel_lines(t):
    """Two sides in many files each, cut at different places, read side by side, line by line."""
    out = [scratch_dir(t.spark, n) for n in ("left", "right")]
    for path, col, parts in zip(out, ("c_name", "c_mktsegment"), (5, 8)):
        t.customer.repartitionByRange(parts, "c_custkey").sortWithinPartitions("c_custkey").select(col).write.text(path)
    return files.zip_lines(t.spark, *out)


@query("parquet_overwrite", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def parquet_overwrite(t):
    """A table written twice holds the second write only."""
    out = scratch_dir(t.spark, "table")
    sinks.write_table(t.orders, out)
    sinks.write_table(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), out)
    return t.spark.read.parquet(out)


@query("save_and_reload", "select l_returnflag, l_linestatus, sum(l_quantity) as quantity from lineitem group by 1, 2")
def save_and_reload(t):
    """An intermediate saved and read again."""
    kept = materialise(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity"))
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"))


@query("write_csv_gzip", "select c_custkey, c_name, c_mktsegment from customer")
def write_csv_gzip(t):
    """A result file as gzip CSV with a header."""
    out = scratch_dir(t.spark, "result")
    sinks.write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), out, gzip=True)
    return files.read_csv(t.spark, out, "c_custkey bigint, c_name string, c_mktsegment string")


@query(
    "report_sections",
    """select 'orders' as section, count(*) as n from orders union all select 'customers', count(*) from customer
       union all select 'parts', count(*) from part""",
)
def report_sections(t):
    """Several result sets in one export."""
    out = scratch_dir(t.spark, "report")
    tables = {"orders": t.orders.select("o_orderkey"), "customers": t.customer.select("c_custkey"), "parts": t.part.select("p_partkey")}
    sinks.write_report(tables, out)
    back = None
    for name in tables:
        one = files.read_csv(t.spark, f"{out}/{name}", "k bigint").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "n")
        back = one if back is None else back.unionByName(one)
    return back


@query("create_and_drop", "select r_regionkey, r_name from region")
def create_and_drop(t):
    """Tables created and dropped more than once."""
    out, name = scratch_dir(t.spark, "made"), "tidemill_regions"
    sinks.drop_table(t.spark, name)
    for _ in range(2):
        sinks.create_table(t.spark, name, t.region.select("r_regionkey", "r_name").schema, out)
    t.region.select("r_regionkey", "r_name").write.mode("append").insertInto(name)
    for _ in range(2):
        sinks.drop_table(t.spark, name)
    return t.spark.read.schema(t.region.select("r_regionkey", "r_name").schema).parquet(out)
