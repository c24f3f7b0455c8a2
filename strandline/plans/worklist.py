"""Registered queries of the archive engine, each with the SQL that must agree.

The first group runs the engine's own operators over ``events`` (cursor
event_id, time ts) and ``orders``; the second the classes of SELECT that its
query service admits.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.config import Job
from ..functions.times import compared, day_of
from ..operators.jobs import ArchiveJob
from ..operators.query import Service
from ..sources.archive import first_of_each
from ..functions.naming import pending_days
from ..sources.hot import FixedTable, ParquetHotTable
from . import relational as R

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
NOW = datetime(2024, 1, 21, tzinfo=timezone.utc)
LATER = datetime(2030, 1, 1, tzinfo=timezone.utc)
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, "events"))


def _orders(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, "orders"))


def workspace(spark: SparkSession) -> str:
    """A folder all executors share: beside the checkpoints where the cluster names such a place; a temporary one only on a local master."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared.rstrip('/')}/archive-{datetime.now().timestamp():.6f}" if shared else tempfile.mkdtemp(prefix="archive-")


def archived(spark: SparkSession, sf_dir: str, rows: int = 500_000, rounds: int | None = None) -> ArchiveJob:
    """events, exported into a fresh archive; ``rounds``: at most so many batches."""
    root = workspace(spark)
    hot = ParquetHotTable(spark, f"{root}/hot", "event_id")
    hot.replace(table(spark, sf_dir, "events"))
    job = ArchiveJob(spark, Job("events", "events", f"{root}/archive", cursor="event_id", time_column="ts", export_rows=rows, delete_rows=100_000, delete_sleep_ms=0, retain_seconds=0), hot)
    while rounds != 0 and job.export(LATER).status == "ok":  # a bounded batch a round
        rounds = rounds and rounds - 1
    return job


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export events, serve the archive, and answer a gated query over a few days of it."""
    job = archived(spark, sf_dir)
    from ..operators.query import admitted

    sql = "SELECT dt, event_type, count(*) AS n FROM events_archive WHERE dt BETWEEN DATE'2024-01-05' AND DATE'2024-01-11' GROUP BY dt, event_type"
    days = admitted(spark, sql, {"events_archive"}).days["events_archive"]
    job.archive.read(*days).createOrReplaceTempView("events_archive")
    return spark.sql(sql)


def overlapped(spark: SparkSession, sf_dir: str) -> ArchiveJob:
    """An archive as a crash leaves it: days in several incremental files, and on the first day a data file that repeats some of their rows."""
    n = table(spark, sf_dir, "events").count()
    job = archived(spark, sf_dir, max(1, -(-n // 60)), rounds=3)
    first = min(job.archive.files(), key=lambda f: f.from_id)
    from ..operators.writer import Segment, write

    rows = job.archive.read_files([first]).drop("dt").withColumn("dt", F.lit(first.dt)).withColumn("seg", F.lit(0))
    write(job.archive, rows, [Segment(0, first.dt, first.from_id, first.to_id, 0)], "data")
    return job


_PART = "(SELECT * FROM events WHERE event_id < 3 * (SELECT CAST(ceil(count(*) / 60.0) AS BIGINT) FROM events))"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = overlapped(spark, sf_dir)
    done = job.compact_pending(LATER)
    files = spark.createDataFrame([(d.dt, d.rows) for d in done if d.merged > 1], "day string, expected long")
    rows = job.archive.read()
    per = rows.groupBy("dt").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))
    return per.join(files, per.dt.cast("string") == files.day, "left").select("dt", "n", "ids", F.coalesce("expected", "n").alias("expected"))  # a day in one file is renamed, not counted


def _overlap_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlapped(spark, sf_dir).archive.read().select("event_id", "user_id", "dt")


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pending_days(archived(spark, sf_dir).archive.files(), "2024-01-15")
    return spark.createDataFrame([(d,) for d in found], "dt string")


def _gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = Job("o", "orders", f"{workspace(spark)}/archive", cursor="o_orderkey", time_column="o_orderdate")
    return spark.createDataFrame([(ArchiveJob(spark, job, FixedTable(table(spark, sf_dir, "orders"), "o_orderkey")).gap("1997-01-01", "1997-12-31"),)], "gap long")


def _one_day_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = Service(spark, {"lake.events": archived(spark, sf_dir).archive})
    r = service.run("SELECT event_type, count(*) AS n, 'lake.events' AS place FROM lake.events WHERE dt = DATE'2024-01-05' AND lake.events.user_id >= 0 GROUP BY event_type")
    return spark.createDataFrame(r.rows, "event_type string, n long, place string")


def _day(encoding: str, source) -> Query:
    return _events(lambda e: e.select("event_id", day_of(source(F.col("ts").cast("timestamp")), encoding, "Asia/Shanghai").alias("dt")))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = archived(spark, sf_dir)
    job.compact_pending(LATER)
    return job.archive.read().groupBy("dt").agg(F.count("*").alias("n"), F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id"))


def _purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = archived(spark, sf_dir)
    job.purge(NOW)
    return job.hot.scan().select("event_id", "user_id")


def _backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark)
    hot = ParquetHotTable(spark, f"{root}/hot", "event_id")
    hot.replace(table(spark, sf_dir, "events"))
    job = ArchiveJob(spark, Job("b", "events", f"{root}/archive", cursor="event_id", time_column="ts"), hot)
    job.backfill("2024-01-01", "2024-01-03")
    return spark.createDataFrame([(f.dt, f.from_id, f.to_id) for f in job.archive.files()], "dt string, min_id long, max_id long")


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of one archive: the second has a wider id and one more column."""
    root = workspace(spark)
    from ..operators.writer import Segment, write
    from ..sources.archive import Archive

    e, archive = table(spark, sf_dir, "events").select("event_id", "user_id"), Archive(spark, root, "event_id")
    half = e.agg((F.max("event_id") / 2).cast("long")).first()[0]
    low = e.where(F.col("event_id") <= half).select("event_id", F.col("user_id").cast("int").alias("user_id"))
    high = e.where(F.col("event_id") > half).withColumn("more", F.lit(1))
    for df, a, b in ((low, 0, half), (high, half + 1, 2 * half + 9)):
        write(archive, df.withColumn("dt", F.lit("2024-01-01")).withColumn("seg", F.lit(0)), [Segment(0, "2024-01-01", a, b, 0)], "inc")
    return archive.read().select("event_id", "user_id", "more")


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Service(spark, {"events": table(spark, sf_dir, "events")}).run("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type", max_rows=3)
    return spark.createDataFrame(r.rows, "event_type string, n long")


_wall = lambda: compared("ts", "<", NOW, "datetime", "UTC")  # noqa: E731  a column needs a session
NATIVE: dict[str, tuple[Query, str | None]] = {
    "dt_from_datetime": (_events(lambda e: e.select("event_id", day_of(F.col("ts"), "datetime", "UTC").alias("dt"))), "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt FROM events"),
    "dt_from_unix_s": (_day("unix_s", F.unix_seconds), "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt FROM events"),
    "dt_from_unix_ms": (_day("unix_ms", F.unix_millis), "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt FROM events"),
    "dt_from_unix_us": (_day("unix_us", F.unix_micros), "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt FROM events"),
    "dt_from_timestamp_tz": (_day("timestamp", lambda c: c), "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt FROM events"),
    "export_roundtrip_count_by_dt": (lambda s, d: archived(s, d).archive.read().groupBy("dt").agg(F.count("*").alias("n")), "SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1"),
    "export_segments": (_events(lambda e: R.segment_spans(e, "event_id", day_of(F.col("ts"), "datetime", "UTC")).select("dt", "min_id", "max_id", "n")), "WITH a AS (SELECT event_id, strftime(ts, '%Y-%m-%d') dt FROM events), b AS (SELECT *, CASE WHEN dt = lag(dt) OVER (ORDER BY event_id) THEN 0 ELSE 1 END c FROM a), g AS (SELECT *, sum(c) OVER (ORDER BY event_id) s FROM b) SELECT dt, min(event_id) AS min_id, max(event_id) AS max_id, count(*) AS n FROM g GROUP BY s, dt"),
    "export_segments_interleaved": (_events(lambda e: R.segment_spans(e, "event_id", (F.col("user_id") % 2).cast("string")).select("dt", "min_id", "max_id", "n")), "WITH a AS (SELECT event_id, CAST(user_id % 2 AS VARCHAR) dt FROM events), b AS (SELECT *, CASE WHEN dt = lag(dt) OVER (ORDER BY event_id) THEN 0 ELSE 1 END c FROM a), g AS (SELECT *, sum(c) OVER (ORDER BY event_id) s FROM b) SELECT dt, min(event_id) AS min_id, max(event_id) AS max_id, count(*) AS n FROM g GROUP BY s, dt"),
    "export_batch_limit": (_events(lambda e: R.batch(e, "event_id", 99, None, 500_000).select("event_id", "user_id")), "SELECT event_id, user_id FROM events WHERE event_id > 99 ORDER BY event_id LIMIT 500000"),
    "safe_bound": (_events(lambda e: R.safe_bound(e, "event_id", _wall(), None, 500_000)), "SELECT max(event_id) AS bound FROM (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-21' ORDER BY event_id LIMIT 500000)"),
    "safe_bound_inverted": (_orders(lambda o: R.safe_bound(o, "o_orderkey", compared("o_orderdate", "<", datetime(1998, 1, 1, tzinfo=timezone.utc), "datetime", "UTC"), 10, 500_000)), "SELECT max(o_orderkey) AS bound FROM (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey > 10 ORDER BY 1 LIMIT 500000)"),
    "archive_lag_count": (lambda s, d: s.createDataFrame([(archived(s, d, 401, rounds=1).status(LATER).lag,)], "lag long"), "SELECT count(*) AS lag FROM events WHERE event_id > 400"),
    "dry_run_summary": (_events(lambda e: R.summary(R.batch(e, "event_id", None, None, 500_000), "event_id")), "SELECT count(*) AS n, min(event_id) AS min_id, max(event_id) AS max_id FROM (SELECT event_id FROM events ORDER BY 1 LIMIT 500000)"),
    "compact_dedup": (_events(lambda e: first_of_each(e.unionByName(e.where("event_id % 3 = 0")), "event_id", ["ts"]).select("event_id", "user_id", "event_type")), "SELECT event_id, user_id, event_type FROM events"),
    "compact_merged_days": (_merged, f"WITH p AS {_PART} SELECT CAST(ts AS DATE) AS dt, count(*) AS n, count(DISTINCT event_id) AS ids, count(*) AS expected FROM p GROUP BY 1"),
    "overlapping_files_read": (_overlap_read, f"WITH p AS {_PART} SELECT event_id, user_id, CAST(ts AS DATE) AS dt FROM p"),
    "compact_days": (_compacted, "SELECT CAST(ts AS DATE) AS dt, count(*) AS n, min(event_id) AS min_id, max(event_id) AS max_id FROM events GROUP BY 1"),
    "pending_compact_dates": (_pending, "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events WHERE ts < TIMESTAMP '2024-01-15'"),
    "purge_bound_eligible": (_events(lambda e: R.summary(e.where(_wall()), "event_id")), "SELECT count(*) AS n, min(event_id) AS min_id, max(event_id) AS max_id FROM events WHERE ts < TIMESTAMP '2024-01-21'"),
    "purge_verify_missing": (_events(lambda e: R.missing(e.where(_wall()), e.where("event_id % 7 <> 0"), "event_id")), "SELECT count(*) AS missing, min(event_id) AS first_missing FROM events WHERE ts < TIMESTAMP '2024-01-21' AND event_id % 7 = 0"),
    "purge_survivors": (_purged, "SELECT event_id, user_id FROM events WHERE NOT ts < TIMESTAMP '2024-01-21'"),
    "backfill_day_files": (_backfilled, "SELECT strftime(ts, '%Y-%m-%d') AS dt, min(event_id) AS min_id, max(event_id) AS max_id FROM events WHERE ts < TIMESTAMP '2024-01-04' GROUP BY 1"),
    "backfill_gap": (_gap, "WITH t AS (SELECT *, o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AS i FROM orders) SELECT count(*) AS gap FROM t WHERE NOT i AND o_orderkey <= (SELECT max(o_orderkey) FROM t WHERE i)"),
    "served_one_day": (_one_day_served, "SELECT event_type, count(*) AS n, 'lake.events' AS place FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' GROUP BY event_type"),
    "backfill_day_overlap": (_orders(lambda o: R.overlaps(R.day_spans(o, "o_orderkey", day_of(F.col("o_orderdate"), "datetime", "UTC")))), "WITH s AS (SELECT strftime(o_orderdate, '%Y-%m-%d') dt, min(o_orderkey) min_id, max(o_orderkey) max_id FROM orders GROUP BY 1), l AS (SELECT *, lag(dt) OVER (ORDER BY dt) before_dt, lag(max_id) OVER (ORDER BY dt) before_max FROM s) SELECT before_dt, dt, before_max, min_id FROM l WHERE before_max >= min_id"),
    "earliest_day": (_events(lambda e: e.agg(F.min(day_of(F.col("ts"), "datetime", "UTC")).alias("dt"))), "SELECT strftime(min(ts), '%Y-%m-%d') AS dt FROM events"),
    "empty_range_schema": (lambda s, d: archived(s, d).archive.read("2031-01-01", "2031-01-02").select("event_id", "user_id"), "SELECT event_id, user_id FROM events WHERE false"),
    "dt_range_pruned_agg": (lambda s, d: flagship(s, d), "SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11' GROUP BY ALL"),
    "schema_union_read": (_drifted, "SELECT event_id, user_id, CASE WHEN event_id > (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) FROM events) THEN 1 END AS more FROM events"),
    "served_top_types": (_served, "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3"),
    "asof_join": (lambda s, d: R.asof_join(table(s, d, "events").select("event_id", "ts", "user_id"), table(s, d, "events").where("event_type = 'purchase'").select("ts", "user_id", F.col("event_id").alias("eid")), "ts", ["user_id"], ["eid"]).select("event_id", "right_eid"), "SELECT l.event_id, r.eid AS right_eid FROM events l ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS eid FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) r ON l.user_id = r.user_id AND l.ts >= r.ts"),
    "positional_join": (lambda s, d: R.positional_join(table(s, d, "customer").select("c_custkey"), ["c_custkey"], table(s, d, "orders").select("o_orderkey"), ["o_totalprice", "o_orderkey"]), "WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) n FROM customer), b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) n FROM orders) SELECT c_custkey, o_orderkey FROM a FULL JOIN b USING (n)"),
}

_SAME = {
    "sql_inner_join": "SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "sql_left_join": "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey",
    "sql_full_join": "SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 3",
    "sql_semi_join": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
    "sql_anti_join": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "sql_theta_join": "SELECT r_name, n_name FROM region JOIN nation ON n_regionkey < r_regionkey",
    "sql_using_join": "SELECT event_type, count(*) AS n FROM events JOIN (SELECT DISTINCT user_id FROM events WHERE value > 10) u USING (user_id) GROUP BY event_type",
    "sql_in_subquery": "SELECT count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "sql_scalar_subquery": "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT 1.9 * avg(o_totalprice) FROM orders)",
    "sql_grouping_sets": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())",
    "sql_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "sql_cube": "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
    "sql_having_distinct": "SELECT user_id, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id HAVING count(*) > 3",
    "sql_filter_agg": "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS many, round(avg(l_discount), 6) AS d FROM lineitem GROUP BY l_returnflag",
    "sql_pricing": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus",
    "sql_percentiles": "SELECT o_orderstatus, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice), 4) AS med FROM orders GROUP BY o_orderstatus",
    "sql_window_rank": "SELECT o_orderkey, r FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) t WHERE r <= 2",
    "sql_window_rows": "SELECT event_id, CAST(sum(user_id) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS s FROM events",
    "sql_window_range": "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY event_id RANGE BETWEEN 50 PRECEDING AND CURRENT ROW) AS n FROM events",
    "sql_window_lag": "SELECT event_id, lag(event_id, 1) OVER w AS before, first_value(event_id) OVER w AS first_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)",
    "sql_union": "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region",
    "sql_union_all": "SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer",
    "sql_intersect": "SELECT o_custkey AS k FROM orders INTERSECT SELECT s_suppkey FROM supplier",
    "sql_except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders",
    "sql_topk_nulls_last": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20",
    "sql_offset": "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 25",
    "sql_recursive_cte": "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 50) SELECT n FROM t",
    "sql_case_cast": "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'high' ELSE 'low' END AS band, CAST(floor(o_totalprice) AS BIGINT) % 7 AS m FROM orders WHERE o_totalprice = o_totalprice AND CAST(floor(o_totalprice * 100) AS BIGINT) % 100 < 40",
    "sql_scalar_string": "SELECT c_custkey, upper(c_name) AS u, length(c_name) AS n, replace(c_mktsegment, 'A', '_') AS r, substr(c_name, 2, 5) AS s, md5(c_name) AS h, trim(c_name) || '!' AS t FROM customer",
    "sql_scalar_math": "SELECT p_partkey, abs(p_size - 25) AS a, round(sqrt(p_size), 6) AS q, greatest(p_size, 10) AS g, coalesce(nullif(p_size, 1), 0) AS z, CAST(ceil(p_retailprice) AS BIGINT) AS c, p_size % 4 AS m FROM part",
    "sql_scalar_date": "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(o_orderdate AS DATE) AS d FROM orders",
    "sql_right_join": "SELECT s_suppkey, n_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey",
    "sql_cross_join": "SELECT r_name, n_name FROM region CROSS JOIN nation",
    "sql_self_join": "SELECT a.n_name AS name, b.n_name AS other FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "sql_except_all": "SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer",
    "sql_intersect_all": "SELECT o_custkey AS k FROM orders INTERSECT ALL SELECT l_suppkey FROM lineitem",
    "sql_window_ranks": "SELECT o_orderkey, dense_rank() OVER w AS d, rank() OVER w AS r, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS q, round(percent_rank() OVER w, 6) AS p, round(cume_dist() OVER w, 6) AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)",
    "sql_group_by_all": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL",
    "sql_mode": "SELECT l_returnflag, mode(l_linestatus) AS m FROM lineitem GROUP BY l_returnflag",
    "sql_bool_agg": "SELECT o_orderstatus, bool_and(o_totalprice > 0) AS every, bool_or(o_totalprice > 400000) AS some, count(DISTINCT o_custkey) AS k, round(stddev_samp(o_totalprice), 2) AS s, round(corr(o_totalprice, o_orderkey), 6) AS c FROM orders GROUP BY o_orderstatus",
    "sql_nulls": "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg, c_acctbal IS NOT DISTINCT FROM NULL AS isn FROM customer",
    "sql_like": "SELECT p_partkey FROM part WHERE p_name LIKE '%a%' AND p_brand NOT LIKE '%1'",
}
# Spark SQL, DuckDB SQL
_TWO = {
    "sql_struct": ("SELECT c_custkey, named_struct('name', c_name, 'seg', c_mktsegment).seg AS seg, map('a', c_nationkey)['a'] AS k FROM customer", "SELECT c_custkey, struct_pack(name := c_name, seg := c_mktsegment).seg AS seg, map {'a': c_nationkey}['a'] AS k FROM customer"),
    "sql_string_agg": ("SELECT n_regionkey, array_join(array_sort(collect_list(n_name)), ',') AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey"),
    "sql_star_except": ("SELECT * EXCEPT (n_regionkey) FROM nation", "SELECT * EXCLUDE (n_regionkey) FROM nation"),
    "sql_union_by_name": ("SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation", "SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL BY NAME SELECT n_name AS name, n_nationkey AS k FROM nation"),
    "sql_sample_all": ("SELECT count(*) AS n FROM events TABLESAMPLE (100 PERCENT)", "SELECT count(*) AS n FROM events"),
    "sql_lateral_top": ("SELECT c.c_custkey, t.o_orderkey FROM customer c, LATERAL (SELECT max(o_orderkey) AS o_orderkey FROM orders o WHERE o.o_custkey = c.c_custkey) t", None),
    "sql_json": ("SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "sql_array": ("SELECT vec_id, size(embedding) AS n, round(CAST(embedding[0] AS DOUBLE), 6) AS first FROM embeddings", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings"),
    "sql_unnest": ("SELECT label, count(*) AS n FROM (SELECT label, explode(embedding) AS x FROM embeddings) t WHERE x > 0 GROUP BY label", "SELECT label, count(*) AS n FROM (SELECT label, unnest(embedding) AS x FROM embeddings) t WHERE x > 0 GROUP BY label"),
    "sql_max_by": ("SELECT o_custkey, max_by(o_orderkey, struct(o_totalprice, o_orderkey)) AS best FROM orders GROUP BY o_custkey", "SELECT o_custkey, arg_max(o_orderkey, struct_pack(a := o_totalprice, b := o_orderkey)) AS best FROM orders GROUP BY o_custkey"),
    "sql_time_bucket": ("SELECT CAST(date_trunc('HOUR', ts) AS timestamp_ntz) AS h, count(*) AS n FROM events GROUP BY 1", "SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1"),
    "sql_regexp": ("SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS b FROM part WHERE p_brand RLIKE '[0-9]'", "SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS b FROM part WHERE regexp_matches(p_brand, '[0-9]')"),
    "sql_qualify": ("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) t WHERE r = 1", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"),
    "sql_pivot": ("SELECT * FROM (SELECT l_returnflag, l_linestatus FROM lineitem) PIVOT (count(*) FOR l_linestatus IN ('F' AS f, 'O' AS o))", "SELECT l_returnflag, nullif(count(*) FILTER (l_linestatus = 'F'), 0) AS f, nullif(count(*) FILTER (l_linestatus = 'O'), 0) AS o FROM lineitem GROUP BY 1"),
}


def _sql(text: str) -> Query:
    used = [t for t in TABLES if t in text]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in used:
            table(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(text)

    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {k: q for k, (q, _) in NATIVE.items()}
    out |= {k: _sql(v) for k, v in _SAME.items()}
    out |= {k: _sql(a) for k, (a, _) in _TWO.items()}
    return out


def oracle_sql() -> dict[str, str]:
    out = {k: s for k, (_, s) in NATIVE.items() if s}
    out |= _SAME
    out |= {k: b or a for k, (a, b) in _TWO.items()}
    return out
