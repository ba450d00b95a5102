import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.loads import load
from tidemill.sources import files, ledger, sinks


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_readers(spark, rows, tmp_path):
    _write(tmp_path / "a/1.json", '{"id": 1, "t": "x"}')
    _write(tmp_path / "a/b/2.json", '{\n "id": 2,\n "t": null}')
    _write(tmp_path / "a/skip.txt", "no")
    got = files.read_json(spark, str(tmp_path / "a"), "id int, t string", multiline=True, recursive=True, pattern="*.json")
    assert rows(got) == [(1, "x"), (2, None)]
    lines = _write(tmp_path / "log.json", '{"id": 3, "t": "p"}\n{"id": 4}')
    assert rows(files.read_json(spark, lines, "id int, t string")) == [(3, "p"), (4, None)]


def test_csv_readers(spark, rows, tmp_path):
    semi = _write(tmp_path / "s.csv", "City;Median Age\nRome;44.1\nOslo;\n")
    assert rows(files.read_csv(spark, semi, "City string, age double", sep=";")) == [("Oslo", None), ("Rome", 44.1)]
    packed = tmp_path / "p.csv.gz"
    packed.write_bytes(gzip.compress(b"1,a\n2,b\n"))
    assert rows(files.read_csv(spark, str(packed), "id int, t string", header=False)) == [(1, "a"), (2, "b")]


def test_broken_rows_are_reported(spark, rows, tmp_path):
    path = _write(tmp_path / "x.json", '{"id": 1}\n{"id": oops}\n')
    good, bad = files.read_checked(spark, path, T.StructType([T.StructField("id", T.IntegerType())]))
    assert rows(good) == [(1,)]
    assert [(r["record"], r["source_file"].endswith("x.json")) for r in bad.collect()] == [('{"id": oops}', True)]


def test_loose_headers(spark, rows, tmp_path):
    a = _write(tmp_path / "a.csv", 'txn date,"Txn Amount",ARN\n2020-01-01,"1,5",r1\n')
    b = _write(tmp_path / "b.csv", " ARN , TXN DATE ,other,TxnAmount\nr2,2020-01-02,z,3\n")
    c = _write(tmp_path / "c.csv", "no,header\n1,2\n")
    good, bad = files.read_loose(spark, [a, b, c], ["TXN DATE", "TXN AMOUNT", "ARN"])
    assert rows(good, "TXN DATE", "TXN AMOUNT", "ARN") == [("2020-01-01", "1,5", "r1"), ("2020-01-02", "3", "r2")]
    assert [r[0].endswith("c.csv") for r in bad.collect()] == [True]
    one = files.match_headers(spark.createDataFrame([(1,)], "`txn  date` int"), ["TXN DATE", "ARN"])
    assert rows(one) == [(1, None)]


def test_csv_cells(spark):
    lines = [",b,", 'a,"x, ""y""",c', '"p\\"q",', "", ",".join(str(i) for i in range(100))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, v string")
    got = {r["i"]: r["c"] for r in df.select("i", files.csv_cells(F.col("v")).alias("c")).collect()}
    assert got[0] == [None, "b", None] and got[1] == ["a", 'x, "y"', "c"] and got[2] == ['p"q', None]
    assert got[3] == [None] and got[4] == [str(i) for i in range(100)]


def test_ledger_opens_each_file_once(spark, rows, tmp_path):
    box, opened = tmp_path / "in", []

    def read(paths):
        opened.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return files.read_json(spark, paths, "id int, v string")

    def load(seen, history):
        got, entered = ledger.load_folder(spark, str(box), read, seen, history, ["id"], "*.json")
        return seen.union(entered), history.union(got)

    seen, history = spark.createDataFrame([], "path string"), spark.createDataFrame([], "id int, v string")
    _write(box / "a/f1.json", '{"id": 1, "v": "x"}\n{"id": 1, "v": "x"}\n{"v": "none"}\n')
    _write(box / "empty.json", "\n")
    _write(box / "other.txt", "no")
    seen, history = load(seen, history)
    assert rows(history) == [(None, "none"), (1, "x")] and seen.count() == 2
    _write(box / "b/f2.json", '{"id": 1, "v": "late"}\n{"id": 2, "v": "y"}\n{"v": "again"}\n')
    seen, history = load(seen, history)
    assert rows(history) == [(None, "none"), (1, "x"), (2, "y")]
    seen, history = load(seen, history)
    assert opened == [["empty.json", "f1.json"], ["f2.json"]] and history.count() == 3


def test_labelled_text_lines_and_source(spark, rows, tmp_path):
    _write(tmp_path / "r/pos/1.txt", "good\nfilm")
    _write(tmp_path / "r/neg/2.txt", "bad")
    assert rows(files.read_labelled_text(spark, str(tmp_path / "r")), "label", "text") == [("neg", "bad"), ("pos", "good\nfilm")]
    a, b = _write(tmp_path / "a.txt", "one\ntwo\n"), _write(tmp_path / "b.txt", "un\ndeux\n")
    assert rows(files.zip_lines(spark, a, b)) == [(0, "one", "un"), (1, "two", "deux")]
    named = files.with_source_file(spark.read.text(a))
    assert rows(named.select("file").distinct()) == [("a.txt",)]


def test_token_budget_takes_the_crossing_row(spark, rows):
    df = spark.createDataFrame([(1, "a b"), (2, "c  d e"), (3, "f"), (4, "g")], "id int, t string")
    assert rows(files.token_budget(df, "t", "id", 4), "id", "run") == [(1, 2), (2, 5)]


def test_explode_nested_json(spark, rows):
    boxes = json.dumps([{"height": 2, "x": 1}, {"height": 3, "x": 4}])
    df = spark.createDataFrame([(7, boxes)], "id int, j string")
    got = files.explode_json(df, "j", "array<struct<height:int,x:int>>")
    assert rows(got.select("id", "col.height", "col.x")) == [(7, 2, 1), (7, 3, 4)]


def test_sinks(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], "id int, t string, year int")
    out = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_table(df, out, ["year"])
    assert rows(spark.read.parquet(out).where("year = 2021"), "id", "t") == [(2, "b")]
    sinks.write_csv(df, str(tmp_path / "c"), gzip=True)
    assert list((tmp_path / "c").glob("*.csv.gz"))
    sinks.write_report({"one": df, "two": df.limit(1)}, str(tmp_path / "rep"))
    assert spark.read.csv(str(tmp_path / "rep/two"), header=True).count() == 1
    load(df, str(tmp_path / "l"), "append")
    load(df, str(tmp_path / "l"), "append")
    assert spark.read.parquet(str(tmp_path / "l")).count() == 4
    load(df, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2


def test_create_and_drop_are_idempotent(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    for _ in range(2):
        sinks.create_table(spark, "tidemill_t", schema, str(tmp_path / "tbl"))
    assert spark.table("tidemill_t").count() == 0
    for _ in range(2):
        sinks.drop_table(spark, "tidemill_t")


def test_keyed_copy_last_write_wins(spark, rows):
    df = spark.createDataFrame([("s", 1, 10, "old"), ("s", 1, 20, "new"), ("s", 2, 5, "x")], "k string, i int, ts int, v string")
    assert rows(sinks.keyed_copy(df, ["k"], ["i"], [F.desc("ts")]), "i", "v") == [(1, "new"), (2, "x")]


def test_stage_replaces(spark, rows, tmp_path):
    src = _write(tmp_path / "in.csv", "id,t\n1,a\n")
    for _ in range(2):
        got = sinks.stage(spark, src, "csv", "id int, t string", str(tmp_path / "stg"))
    assert rows(got) == [(1, "a")]


def test_date_range_reaches_the_scan(spark, tmp_path):
    out = str(tmp_path / "d")
    spark.range(5).select(F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0,0,0,id)").alias("d"), "id").write.parquet(out)
    got = files.between_dates(spark.read.parquet(out), "d", "2020-01-02", "2020-01-03").select("id")
    assert got.count() == 2
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("budget,expect", [(0, 1), (100, 4)])
def test_budget_edges(spark, budget, expect):
    df = spark.createDataFrame([(i, "w w") for i in range(4)], "id int, t string")
    assert files.token_budget(df, "t", "id", budget).count() == expect


def test_loose_headers_with_line_breaks(spark, rows, tmp_path):
    _write(tmp_path / "one.csv", 'ARN, txn date\n"a ""1""\nb",x\n\nc,\n')
    _write(tmp_path / "two.csv", 'Txn Date,other,arn\ny,1,d\n')
    _write(tmp_path / "none.csv", "nothing,here\n")
    paths = [str(tmp_path / n) for n in ("one.csv", "two.csv", "none.csv")]
    good, bad = files.read_loose(spark, paths, ["TXN DATE", "ARN"], width=5)
    assert rows(good, "TXN DATE", "ARN") == [(None, "c"), ("x", 'a "1"\nb'), ("y", "d")]
    assert [r[0].rsplit("/", 1)[1] for r in bad.collect()] == ["none.csv"]


def test_texts_are_dealt_to_tasks_by_their_number(spark, rows, tmp_path, monkeypatch):
    """Before, a few bytes were one task, which wrote all files one after the other."""
    monkeypatch.setattr(sinks, "FILES_A_TASK", 5)
    df = spark.createDataFrame([(i, f"text\n{i}") for i in range(40)], "k long, text string").coalesce(1)
    sinks.write_texts(df, "k", "text", str(tmp_path / "r" / "pos"))
    names = [p.name for p in (tmp_path / "r" / "pos").glob("part-*")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) >= 6
    back = files.read_labelled_text(spark, str(tmp_path / "r"))
    assert rows(back, "label", "text") == sorted(("pos", f"text\n{i}\u0000") for i in range(40))
