"""A job over a JDBC table: the embedded database of Spark's own jars."""

from datetime import datetime, timedelta, timezone

import pytest

from strandline.functions.config import Job
from strandline.functions.times import Before
from strandline.operators.jobs import ArchiveJob
from strandline.sources.hot import JdbcHotTable, WritersActive

NOW = datetime(2024, 3, 10, 12, tzinfo=timezone.utc)


def test_export_and_purge(spark, tmp_path):
    url = "jdbc:derby:memory:strandline"
    conn = spark._jvm.java.sql.DriverManager.getConnection(f"{url};create=true")
    try:
        run = conn.createStatement().executeUpdate
        run('CREATE TABLE "logs" ("id" BIGINT NOT NULL PRIMARY KEY, "created_at" TIMESTAMP NOT NULL, "content" VARCHAR(20))')
        for i, days in enumerate([3, 3, 0.5, 3, 2]):
            at = (NOW - timedelta(days=days)).replace(tzinfo=None).isoformat(sep=" ")
            run(f"INSERT INTO \"logs\" VALUES ({i + 1}, TIMESTAMP('{at}'), 'line-{i + 1}')")
    finally:
        conn.close()
    JdbcHotTable.SHARE = 2  # several connections even here
    hot = JdbcHotTable(spark, url, "logs", "id", "derby", driver="org.apache.derby.jdbc.EmbeddedDriver", preferTimestampNTZ="true")
    job = ArchiveJob(spark, Job("j", "logs", f"{tmp_path}/archive", delete_rows=2, delete_sleep_ms=0), hot)
    assert (job.export(NOW).rows, job.archive.read().count()) == (5, 5)
    done = job.purge(NOW)
    assert (done.status, done.eligible, done.deleted, done.batches) == ("ok", 4, 4, 2)
    assert [r.id for r in hot.scan().collect()] == [3]


class Guarded(JdbcHotTable):
    """A server with scripted answers: the next id, then the open transactions at each look."""

    def __init__(self, spark, looks, given="8"):
        super().__init__(spark, "jdbc:none", "app.logs", "id", user="u", password="p")
        self.looks, self.given, self.asked = list(looks), given, []

    def column(self, sql, first=None):
        self.asked.append(sql)
        return [self.given] if "AUTO_INCREMENT" in sql else self.looks.pop(0)


def test_guard_of_open_transactions(spark):
    slept = []
    assert Guarded(spark, [[]]).write_guard(5, slept.append) == 7 and slept == [0.2]
    assert Guarded(spark, [["a", "b"], ["c"]]).write_guard(60, slept.append) == 7 and slept[-1] == 30
    with pytest.raises(WritersActive):
        Guarded(spark, [["a", "b"], ["b"]]).write_guard(1, slept.append)
    with pytest.raises(ValueError):
        Guarded(spark, [[]], None).write_guard(1, slept.append)
    g = Guarded(spark, [[]])
    g.write_guard(0, slept.append)
    assert "AUTO_INCREMENT" in g.asked[0] and "TABLE_SCHEMA = 'app' AND TABLE_NAME = 'logs'" in g.asked[0]  # ids first, then transactions
    assert g.range_sql(3, 9, 100) == "SELECT * FROM `app`.`logs` WHERE `id` > 3 AND `id` <= 9 ORDER BY `id` LIMIT 100"


def test_export_stalls_while_writers_are_open(spark, tmp_path):
    job = ArchiveJob(spark, Job("j", "logs", f"{tmp_path}/archive"), Guarded(spark, [["a"], ["a"]]))
    job.hot.scan = lambda sql=None: spark.range(3)
    guard = job.hot.write_guard
    job.hot.write_guard = lambda wait: guard(wait, lambda s: None)
    assert job.export(NOW).status == "stalled" and job.archive.files() == []


@pytest.mark.parametrize("encoding,want", [("unix_s", "c < 1710072000"), ("unix_ms", "c < 1710072000000"), ("unix_us", "c < 1710072000000000"), ("datetime", "c < TIMESTAMP('2024-03-10 20:00:00')"), ("timestamp", "c < FROM_UNIXTIME(1710072000)")])
def test_cutoffs_as_sql(encoding, want):
    assert Before("c", NOW, encoding, "Asia/Shanghai").sql("c") == want
