import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.operators import quality as Q
from tidemill.plans import reconciliation as R
from tidemill.plans import star
from tidemill.streaming import jobs

MS = 1541106106000


def _staging(spark):
    events = spark.createDataFrame(
        [
            ("S", "A", 10.5, "NextSong", MS, 1, 7, "Ann", "free", "Rome", "ua"),
            ("S", "A", 10.5, "NextSong", MS, 1, 7, "Ann", "free", "Rome", "ua"),
            ("Q", "B", 3.0, "NextSong", MS + 5000, 1, 7, "Ann", "paid", "Rome", "ua"),
            (None, None, None, "Home", MS, 2, 8, "Bob", "free", "Oslo", "ua"),
        ],
        "song string, artist string, length double, page string, ts bigint, sessionid int, userid int, firstname string, level string, location string, useragent string",
    )
    songs = spark.createDataFrame(
        [("s1", "S", "a1", "A", "X", 10.5, 1999)],
        "song_id string, title string, artist_id string, artist_name string, artist_location string, duration double, year int",
    )
    return events, songs


def test_star_schema(spark, rows, tmp_path):
    s = star.star_schema(*_staging(spark))
    assert rows(s["songplays"], "song_id", "level") == [(None, "paid"), ("s1", "free")]
    assert rows(s["users"]) == [(7, "Ann", "free"), (7, "Ann", "paid")]
    assert s["time"].count() == 2
    checks = star.star_checks(s)
    assert all(r["passed"] for r in checks.collect())
    star.write_star(s, str(tmp_path / "star"))
    back = spark.read.parquet(str(tmp_path / "star/songplays"))
    assert rows(back.select("year", "month").distinct()) == [(2018, 11)]
    star.write_star(s, str(tmp_path / "rel"), release_year=True)
    assert rows(spark.read.parquet(str(tmp_path / "rel/songplays")).select("year").distinct()) == [(None,), (1999,)]


def test_duplicate_second_fails_the_check(spark):
    events, songs = _staging(spark)
    later = events.where("song = 'S'").withColumns({"ts": F.col("ts") + 300, "location": F.lit("Bonn")})
    checks = star.star_checks(star.star_schema(events.unionByName(later), songs))
    assert not checks.where("check = 'unique_playid'").first()["passed"]
    with pytest.raises(Q.CheckFailed):
        Q.enforce(checks)


def test_checks(spark, rows):
    a, empty = spark.range(3), spark.range(0)
    assert rows(Q.check_nonempty({"a": a, "e": empty}), "check", "passed") == [("nonempty_a", True), ("nonempty_e", False)]
    assert Q.check_expected("n", a.agg(F.count("*")), 3).first()["passed"]
    assert rows(Q.table_shape({"a": a})) == [("a", 1, 3)]


def test_reconcile(spark, rows):
    d = dt.datetime(2020, 1, 1)
    refunds = spark.createDataFrame(
        [
            (1, 1, 1, 10.0, d, "SUCCESS"), (1, 1, 1, 10.0, d + dt.timedelta(1), "SUCCESS"),
            (2, 2, 2, 5.005, d, "FAILED"), (3, 3, 3, 7.0, d, "FAILED"), (3, 4, 4, 8.0, d, "FAILED"), (4, 5, 5, 1.0, d, "SUCCESS"),
        ],
        "order_number int, return_id int, pps_id int, amount double, attempted timestamp, status string",
    )
    settled = spark.createDataFrame(
        [(1, "a", d, d, 10.0), (2, "b", d, d, 5.01), (3, "c", d + dt.timedelta(2), d, 2.0), (9, "z", d, d, 3.0)],
        "order_info int, arn string, txn_date timestamp, settlement_date timestamp, txn_amount double",
    )
    out = R.reconcile(refunds, settled)
    n = {k: v.count() for k, v in out.items()}
    assert n == {
        "matched": 1, "not_settled": 1, "failed_settled": 1, "failed_open": 2, "isolated": 2, "short_paid": 1, "repeats": 0, "missing_days": 1,
    }
    assert rows(out["short_paid"], "order_number", "refund_sum", "settled_sum")[0][0] == 3
    assert rows(R.settled_without_order(R.clean_settlements(settled), R.clean_refunds(refunds)), "arn") == [("z",)]


def test_failure_classes(spark):
    df = spark.createDataFrame([(None, "new"), (None, "ticket raised"), (None, "ticket opened"), (5, "new")], "ticket int, state string")
    assert [r["class"] for r in R.failure_classes(df).collect()] == ["no_ticket", "ticket_missing", "other", "other"]


def test_ingest_stream_is_idempotent(spark, rows, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.createDataFrame([(1, "a"), (1, "a")], "id int, v string").write.parquet(src)
    run = lambda: jobs.ingest_stream(jobs.file_stream(spark, src, "id int, v string"), out, cp, ["id"], None).awaitTermination()
    run()
    run()
    assert rows(spark.read.parquet(out), "id", "v") == [(1, "a")]
    spark.createDataFrame([(1, "z"), (2, "b")], "id int, v string").write.mode("append").parquet(src)
    run()
    assert rows(spark.read.parquet(out), "id", "v") == [(1, "a"), (2, "b")]


def test_upsert_batches_replay(spark, rows, tmp_path):
    out = str(tmp_path / "u")
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "id int, t int, v string")
    second = spark.createDataFrame([(1, 9, "late"), (2, 1, "c")], "id int, t int, v string")
    for df, batch in ((first, 0), (second, 1), (second, 1)):
        jobs.upsert_batch(df, batch, out, ["id"], [F.desc("t")])
    assert rows(spark.read.parquet(out), "id", "v") == [(1, "b"), (2, "c")]


def test_bounded_ingest(spark, rows, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (1, dt.datetime(2020, 1, 1))], "id int, ts timestamp").write.parquet(src)
    q = jobs.ingest_stream(jobs.file_stream(spark, src, "id int, ts timestamp"), out, cp, ["id"], "ts", "1 hour")
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_late_rows_are_loaded_once(spark, rows, tmp_path):
    """A file two months late: its new rows come in, its copies of old and of recent rows do not; also when a batch runs again."""
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(n)
    run = lambda: jobs.ingest_stream(jobs.file_stream(spark, src, "id int, ts timestamp"), out, cp, ["id"], "ts", "30 days").awaitTermination()
    files = [
        [(1, day(0)), (2, day(1)), (2, day(1))],
        [(3, day(100)), (4, day(101)), (1, day(0))],  # the copy of 1 is late
        [(5, day(40)), (2, day(1)), (6, None), (4, day(101)), (7, day(102))],  # 5 is two months late
        [(5, day(40)), (6, None), (3, day(99)), (8, day(5))],
    ]
    want = [{1, 2}, {1, 2, 3, 4}, {1, 2, 3, 4, 5, 6, 7}, {1, 2, 3, 4, 5, 6, 7, 8}]
    for part, ids in zip(files, want):
        spark.createDataFrame(part, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(src)
        run()
        assert rows(spark.read.parquet(out), "id") == [(i,) for i in sorted(ids)]
    run()
    assert spark.read.parquet(out).count() == 8
    again = spark.createDataFrame(files[3], "id int, ts timestamp")
    jobs.store.append_timed(jobs.store.hashed(again, ["id"]), 3, out, ["id"], "ts", "30 days")
    assert rows(spark.read.parquet(out), "id") == [(i,) for i in range(1, 9)]


@pytest.mark.parametrize("listed", [2_000, 5])
def test_store_reads_touched_buckets_only(spark, rows, tmp_path, monkeypatch, listed):
    """Large batches are cut finer; a batch of few keys reads few of their files, and finds its repeated key."""
    monkeypatch.setattr(jobs.store, "BUCKET_ROWS", 500)
    monkeypatch.setattr(jobs.store, "LISTED", listed)
    out = str(tmp_path / "u")
    newest = [F.desc("t")]
    jobs.upsert_batch(spark.range(20_000).withColumn("t", F.lit(0)), 0, out, ["id"], newest)
    jobs.upsert_batch(spark.range(19_990, 20_400).withColumn("t", F.lit(1)), 1, out, ["id"], newest)
    few = jobs.store.hashed(spark.range(20_398, 20_404).withColumn("t", F.lit(2)), ["id"])
    kept = jobs.store.stored(spark, out, 2, few)
    files = lambda df: df._jdf.queryExecution().sparkPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles()
    assert files(kept) >= 65 and files(jobs.store.around(kept, few)) <= (8 if listed > 5 else 70)
    assert {r["depth"] for r in kept.select("depth").distinct().collect()} == {0, 6}
    jobs.upsert_batch(few.drop("_k"), 2, out, ["id"], newest)
    assert rows(spark.read.parquet(out).select("id")) == [(i,) for i in range(20_404)]
    assert rows(spark.read.parquet(out).where("t = 2").select("id")) == [(i,) for i in range(20_400, 20_404)]


def test_star_stream_keeps_latest_user_and_all_tables(spark, rows, tmp_path):
    events, songs = _staging(spark)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    events.write.parquet(src)
    jobs.star_stream(jobs.file_stream(spark, src, events.schema), songs, out, out + "-cp").awaitTermination()
    newest = {r["userid"]: r for r in events.where("page = 'NextSong' and userid is not null").orderBy("ts").collect()}
    got = {r["userid"]: r["level"] for r in spark.read.parquet(f"{out}/users").collect()}
    assert got == {u: r["level"] for u, r in newest.items()}
    for name in ("songplays", "time", "songs", "artists"):
        assert spark.read.parquet(f"{out}/{name}").count() > 0
