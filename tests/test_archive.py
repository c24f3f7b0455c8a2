"""The archive's guarantees: names, exports, compaction, purge, backfill, the gate."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from strandline.functions import naming
from strandline.functions.config import Config, ConfigError, Job
from strandline.functions.times import day_bounds, day_of
from strandline.operators import query as Q
from strandline.operators.jobs import ArchiveJob, Refused, throughput
from strandline.sources.hot import JdbcHotTable, ParquetHotTable

NOW = datetime(2024, 3, 10, 12, tzinfo=timezone.utc)


def make(spark, tmp_path, days, **how):
    """A hot table with one row per entry: days before NOW."""
    rows = [(i + 1, (NOW - timedelta(days=d)).replace(tzinfo=None).isoformat(sep=" "), i % 7) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id long, t string, user_id int").withColumn("created_at", F.col("t").cast("timestamp_ntz")).drop("t")
    hot = ParquetHotTable(spark, f"{tmp_path}/hot", "id")
    hot.replace(df)
    return ArchiveJob(spark, Job("j", "logs", f"{tmp_path}/archive", **({"safety_lag_seconds": 0, "delete_sleep_ms": 0} | how)), hot)


def names(job):
    return [f.name for f in sorted(job.archive.files(), key=lambda f: f.from_id)]


@pytest.mark.parametrize("path,ok", [("p/dt=2024-01-01/inc-1-2.parquet", True), ("p/dt=2024-01-01/data-3-3.parquet", True), ("p/dt=2024-01-01/inc-3-2.parquet", False), ("p/dt=2024-1-1/inc-1-2.parquet", False), ("p/x/dt=2024-01-01/inc-1-2.parquet", False), ("p/dt=2024-01-01/tmp-data-1-2.parquet.tmp", False), ("q/dt=2024-01-01/inc-1-2.parquet", False)])
def test_names(path, ok):
    assert (naming.parse(path, "p") is not None) == ok


def test_live_files_ignore_leftovers():
    f = lambda k, a, b: naming.parse(f"p/dt=2024-01-01/{k}-{a}-{b}.parquet", "p")
    assert [x.name for x in naming.live([f("inc", 1, 5), f("inc", 6, 9), f("data", 1, 9), f("inc", 10, 12)])] == ["data-1-9.parquet", "inc-10-12.parquet"]
    assert naming.live([f("data", 1, 9), f("inc", 1, 9)])[0].kind == "data"
    assert naming.high_water([]) is None


def test_days_in_zones(spark):
    at = datetime(2026, 6, 11, 23, 30, tzinfo=ZoneInfo("Asia/Shanghai"))
    df = spark.range(1).select(day_of(F.lit(int(at.timestamp())), "unix_s", "Asia/Shanghai").alias("a"), day_of(F.lit(int(at.timestamp())), "unix_s", "UTC").alias("b"))
    assert tuple(df.first()) == ("2026-06-11", "2026-06-11")
    a, b = day_bounds("2024-03-31", "Europe/Berlin")
    assert (b - a) == timedelta(days=1) and b.timestamp() - a.timestamp() == 23 * 3600


def test_export_segments_batches_and_reruns(spark, tmp_path):
    job = make(spark, tmp_path, [2, 2, 2, 1, 1, 2], export_rows=4)
    assert job.export(NOW, dry_run=True).rows == 4 and names(job) == []
    r = job.export(NOW)
    assert (r.status, r.rows, r.lag) == ("ok", 4, 2)
    assert job.export(NOW).rows == 2 and job.export(NOW).status == "empty"
    assert names(job) == ["inc-1-3.parquet", "inc-4-4.parquet", "inc-5-5.parquet", "inc-6-6.parquet"]
    assert job.archive.read().count() == 6


def test_safety_lag_takes_younger_rows_below_the_bound(spark, tmp_path):
    job = make(spark, tmp_path, [1] * 5 + [-1] + [1] + [-1], safety_lag_seconds=5)
    assert job.export(NOW).to_id == 7


def test_guard_stalls(spark, tmp_path):
    job = make(spark, tmp_path, [1, 1, 1])
    job.hot.write_guard = lambda wait: 1
    assert job.export(NOW).to_id == 1
    assert job.export(NOW).status == "stalled"


def test_compact_then_read_once(spark, tmp_path):
    job = make(spark, tmp_path, [1] * 25, export_rows=10)
    while job.export(NOW).status == "ok":
        pass
    assert [(c.status, c.merged, c.rows) for c in job.compact_pending(NOW)] == [("ok", 3, 25)]
    assert names(job) == ["data-1-25.parquet"] and job.compact("2024-03-09").status == "skip"
    assert job.archive.read().count() == 25


def test_purge_only_what_is_archived_and_expired(spark, tmp_path):
    job = make(spark, tmp_path, [5] * 6 + [0] + [5] * 3, delete_rows=4)
    assert job.purge(NOW).status == "empty"
    job.export(NOW)
    r = job.purge(NOW)
    assert (r.status, r.deleted, r.batches) == ("ok", 9, 3)
    assert [x.id for x in job.hot.scan().collect()] == [7]


def test_purge_refuses_if_the_archive_lacks_a_row(spark, tmp_path):
    job = make(spark, tmp_path, [5] * 10)
    job.export(NOW)
    f = job.archive.files()[0]
    spark.read.parquet(f.path).where("id <> 4").coalesce(1).write.parquet(f"{tmp_path}/x")
    job.archive.store.rename(job.archive.store.parts(f"{tmp_path}/x")[0], f.path)
    r = job.purge(NOW)
    assert (r.status, r.missing, r.first_missing) == ("verify-failed", 1, 4) and job.hot.scan().count() == 10


def test_backfill_and_its_refusals(spark, tmp_path):
    job = make(spark, tmp_path, [4, 4, 3, 3, 2])
    with pytest.raises(Refused):
        job.backfill("2024-03-07", "2024-03-07")
    r = job.backfill("2024-03-05", "2024-03-07")
    assert r.days == {"2024-03-05": "empty", "2024-03-06": "ok", "2024-03-07": "ok"} and r.rows == 4
    assert set(job.backfill("2024-03-06", "2024-03-07").days.values()) == {"skip"}
    assert job.export(NOW).from_id == 5


def test_checks_and_rate(spark, tmp_path):
    job = make(spark, tmp_path, [1, 2])
    assert not any(job.check().values())
    job.hot.replace(job.hot.scan().union(job.hot.scan()))
    assert job.check()["unique"]
    assert throughput([(100.0, 1, 10)], 200) is None and throughput([(100.0, 1, 10), (110.0, 11, 30)], 200) == 3.0


def test_config():
    with pytest.raises(ConfigError):
        Job("a", "t", "p/../q")
    with pytest.raises(ConfigError):
        Config((Job("a", "t", "p"), Job("b", "t", "p/")))


def test_dialects(spark):
    m, d = (JdbcHotTable(spark, "jdbc:x", "logs", "id", x) for x in ("mysql", "derby"))
    assert m.range_sql(5, None, 10) == "SELECT * FROM `logs` WHERE `id` > 5 ORDER BY `id` LIMIT 10"
    assert "FETCH FIRST 10 ROWS ONLY" in d.delete_sql(9, "x < 1", 10)


REFUSED = ["DROP TABLE t", "SELECT * FROM other", "SELECT reflect('a', 'b')", "SELECT * FROM parquet.`/tmp`", "SELECT 1; SELECT 2", "SELECT TRANSFORM(a) USING 'cat' FROM t", "SELECT _metadata FROM t", "SELECT * FROM IDENTIFIER('t')", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT * FROM a.b.c", "VALUES (1)", "SET x = 1"]


@pytest.mark.parametrize("sql", REFUSED)
def test_gate_refuses(spark, sql):
    with pytest.raises(Q.Rejected):
        Q.Service(spark, {"t": spark.range(3).toDF("a")}).run(sql)


def test_service(spark):
    s = Q.Service(spark, {"t": spark.range(5).toDF("a"), "db.t": spark.range(2).toDF("a")}, max_rows=3)
    r = s.run("SELECT a, a FROM t ORDER BY a;")
    assert (r.columns, r.row_count, r.truncated) == (["a", "a_1"], 3, True)
    assert s.run("SELECT count(*) FROM db.t WHERE a IN (SELECT a FROM t)").rows == [(2,)]
    with pytest.raises(Q.Rejected):
        s.run("SELECT 1 UNION SELECT 2", strict=True)
    assert Q.meta(s, "SHOW TABLES FROM db") == [("db", "t")]
    assert Q.to_csv(s.run("SELECT 'a,\"b' AS x, array(1) AS y, NULL AS z")) == 'x,y,z\r\n"a,""b",[1],\r\n'
    with pytest.raises(Q.Timeout):
        s.run("SELECT sum(a.id * b.id) FROM range(4000000) a, range(400000) b", timeout_seconds=0.5)


def test_a_query_over_one_day_lists_and_opens_that_day(spark, tmp_path):
    job = make(spark, tmp_path, [4, 4, 3, 3, 2, 2, 1])
    assert job.export(NOW).rows == 7
    listed, store = [], job.archive.store
    whole = store.files
    store.files = lambda days=None: listed.append(days) or whole(days)
    service = Q.Service(spark, {"lake.logs": job.archive})
    sql = "SELECT id, 'lake.logs' AS s, lake.logs.user_id FROM lake.logs WHERE dt = DATE'2024-03-07' ORDER BY id"
    assert service.run(sql).rows == [(3, "lake.logs", 2), (4, "lake.logs", 3)]
    assert listed == [["2024-03-07"]]
    assert all("dt=2024-03-07" in f for f in job.archive.read("2024-03-07", "2024-03-07").inputFiles())
    assert service.run("SELECT * FROM lake.logs WHERE dt > '2025-01-01'").columns == ["id", "user_id", "created_at", "dt"]  # the schema without a row
    job.hot.replace(spark.createDataFrame([(8, 1, datetime(2024, 3, 9))], "id long, user_id int, created_at timestamp_ntz"))
    assert job.export(NOW).rows == 1 and service.run("SELECT count(*) FROM lake.logs").rows == [(8,)]  # new files are seen
    assert service.run("SELECT count(*) FROM lake.logs a JOIN lake.logs b USING (id) WHERE a.dt = '2024-03-07'").rows == [(2,)]


def test_compaction_counts_before_it_publishes(spark, tmp_path):
    from strandline.operators import jobs
    from strandline.operators.writer import Segment, write

    job = make(spark, tmp_path, [1] * 25, export_rows=10)
    while job.export(NOW).status == "ok":
        pass
    some = job.archive.read_files(job.archive.files()[:1]).withColumn("seg", F.lit(0)).withColumn("dt", F.lit("2024-03-09")).withColumn("user_id", F.lit(99))
    write(job.archive, some, [Segment(0, "2024-03-09", 1, 10, 10)], "data")
    before = names(job)
    first = jobs.first_of_each
    jobs.first_of_each = lambda *a: first(*a).limit(24)
    try:
        with pytest.raises(Refused):
            job.compact("2024-03-09")
    finally:
        jobs.first_of_each = first
    assert names(job) == before  # nothing was published, nothing deleted
    assert job.archive.read().where("user_id = 99").count() == 10  # of repeated ids the data file's row
    done = job.compact("2024-03-09")
    assert (done.rows, done.merged) == (25, 4) and names(job) == ["data-1-25.parquet"]
    assert job.archive.read().where("user_id = 99").count() == 10


def test_backfill_tells_of_its_days(spark, tmp_path):
    job, seen = make(spark, tmp_path, [3, 3, 2, 1]), []
    job.backfill("2024-03-07", "2024-03-09", on_day=lambda *a: seen.append(a))
    assert seen == [("2024-03-07", 2, 2), ("2024-03-08", 1, 3), ("2024-03-09", 1, 4)]


class Fake:
    def __init__(self, **how):
        self.job, self.calls, self.fail = Job("f", "t", "p", **how), [], False

    def export(self, now):
        self.calls.append("export")

    def compact_pending(self, now):
        self.calls.append("compact")
        if self.fail:
            raise RuntimeError("x")

    def purge(self, now):
        self.calls.append("purge")


def test_scheduler():
    import threading
    import time

    from strandline.streaming import scheduler as S

    registry, job = S.Registry(), Fake()
    S.daily(job, registry, NOW)
    assert job.calls == ["compact", "purge"]
    job.fail, job.calls = True, []
    S.daily(job, registry, NOW)
    assert job.calls == ["compact"] and "RuntimeError" in registry.states["f", "compact"].error
    S.daily(own := Fake(purge_interval_seconds=9), registry, NOW)
    assert own.calls == ["compact"]
    held, stop = threading.Event(), threading.Event()
    t = threading.Thread(target=registry.run, args=("f", "export", held.wait))
    t.start()
    while registry.states.get(("f", "export")) is None or registry.states["f", "export"].state != "running":
        time.sleep(0.01)
    assert not registry.run("f", "export", lambda: 1)  # no overlap
    held.set()
    t.join()
    job = Fake(compact_at="03:00")
    t = threading.Thread(target=S.serve, args=([job], stop, registry, lambda: NOW))
    t.start()
    time.sleep(0.4)
    stop.set()
    t.join(10)
    assert not t.is_alive() and job.calls.count("export") == 1 and job.calls.count("compact") == 1


def test_missed_rounds_are_not_made_up():
    from strandline.streaming.scheduler import next_due

    assert next_due(100.0, 30.0, 105.0) == 130.0
    assert next_due(100.0, 30.0, 195.0) == 220.0  # three were missed; one runs, and the rhythm stays
