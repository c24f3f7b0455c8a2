"""Command line: check, status, ps, run, backfill, compact, purge, serve, query.

Exit codes: 0 done, 1 refused or a failed check, 2 configuration or arguments,
3 SQL, 4 engine, 5 limits.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import signal
import sys
import threading
import urllib.request
from datetime import date, timedelta

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import SparkSession

from ..functions.config import Config, ConfigError, load
from ..functions.times import today, utc_now
from ..operators import query as Q
from ..operators.jobs import ArchiveJob, Refused
from ..sources.archive import Archive
from ..sources.hot import JdbcHotTable, ParquetHotTable
from ..streaming.scheduler import Registry
from ..streaming.scheduler import serve as schedule
from .http import server
from .isolation import Killed, isolated
from .output import OutputError, emit, log_to_stderr, redact

QUERY_SECONDS, QUERY_ROWS = 300.0, 1_000


def archive_job(spark: SparkSession, config: Config, name: str) -> ArchiveJob:
    """The job's table is a JDBC table if ARCHIVE_JDBC_URL is set, else a folder of Parquet snapshots."""
    job, url = config.job(name), os.environ.get("ARCHIVE_JDBC_URL")
    hot = JdbcHotTable(spark, url, job.table, job.cursor) if url else ParquetHotTable(spark, job.table, job.cursor)
    return ArchiveJob(spark, job, hot)


def archive_views(spark: SparkSession, config: Config) -> dict:
    """Each job's archive, listed anew by every query."""
    return {j.name: Archive(spark, j.prefix, j.cursor) for j in config.jobs}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandline", description="Archive append-only tables and query the archive.")
    p.add_argument("--config", help="YAML file; ARCHIVE_CONFIG by default")
    sub = p.add_subparsers(dest="command", required=True)
    job = {name: sub.add_parser(name) for name in ("check", "status", "run", "backfill", "compact", "purge")}
    for name, s in job.items():
        s.add_argument("job", nargs="?" if name in ("check", "status") else None)
    for name in ("run", "purge"):
        job[name].add_argument("--dry-run", action="store_true")
    job["backfill"].add_argument("--from", dest="first", help="YYYY-MM-DD; the earliest day by default")
    job["backfill"].add_argument("--to", dest="last", help="YYYY-MM-DD; yesterday by default")
    job["backfill"].add_argument("--force", action="store_true")
    job["compact"].add_argument("--dt", help="YYYY-MM-DD; every pending day by default")
    ps = sub.add_parser("ps")
    ps.add_argument("--key", default=os.environ.get("ARCHIVE_KEY", ""))
    sub.add_parser("serve")
    q = sub.add_parser("query")
    q.add_argument("sql")
    q.add_argument("--format", choices=("json", "csv"), default="json")
    q.add_argument("--no-header", action="store_true")
    q.add_argument("--output")
    q.add_argument("--max-rows", type=int, default=QUERY_ROWS)
    q.add_argument("--timeout", type=float, default=QUERY_SECONDS)
    q.add_argument("--max-bytes", type=int, help="largest result, as JSON")
    q.add_argument("--strict", action="store_true", help="no table functions, no set operations on top")
    q.add_argument("--isolate", action="store_true", help="run in a process that is ended at the deadline")
    return p


def _day(text: str) -> str:
    try:
        return date.fromisoformat(text).isoformat()
    except ValueError:
        raise ConfigError(f"not a day: {text!r}") from None


def _show(thing) -> None:
    emit(json.dumps(dataclasses.asdict(thing) if dataclasses.is_dataclass(thing) else thing, default=str))


def query(spark: SparkSession, config: Config, a: argparse.Namespace) -> int:
    if a.max_rows < 1 or a.timeout <= 0:
        raise ConfigError("--max-rows and --timeout must be positive")
    service = Q.Service(spark, archive_views(spark, config), a.max_rows, a.timeout, a.max_bytes)
    if (answer := Q.meta(service, a.sql)) is not None:
        emit(json.dumps(answer), a.output)
        return 0
    done = service.run(a.sql, strict=a.strict)
    if done.truncated:
        print(f"Only the first {a.max_rows} rows are shown.", file=sys.stderr)
    emit(Q.to_json(done) if a.format == "json" else Q.to_csv(done, not a.no_header), a.output)
    return 0


def serve(spark: SparkSession, config: Config, stop: threading.Event) -> int:
    """Scheduler and, if enabled, the query service, until ``stop``; running batches are waited for."""
    registry, web = Registry(), None
    if config.query_api.enabled:
        api = config.query_api
        web = server(api, Q.Service(spark, archive_views(spark, config), api.max_rows, api.timeout_seconds), registry)
        threading.Thread(target=web.serve_forever, daemon=True).start()
    try:
        schedule([archive_job(spark, config, j.name) for j in config.jobs], stop, registry)
        stop.wait()
    finally:
        if web:
            web.shutdown()
            web.server_close()
    return 0


def dispatch(spark: SparkSession, config: Config, a: argparse.Namespace) -> int:
    now = utc_now()
    if a.command == "query":
        return query(spark, config, a)
    if a.command == "serve":
        stop = threading.Event()
        for s in (signal.SIGTERM, signal.SIGINT):
            signal.signal(s, lambda *_: stop.set())
        return serve(spark, config, stop)
    if a.command in ("check", "status"):
        bad = False
        for name in [a.job] if a.job else [j.name for j in config.jobs]:
            job = archive_job(spark, config, name)
            if a.command == "status":
                _show({"job": name} | dataclasses.asdict(job.status(now)))
            else:
                report = job.check()
                bad |= any(report.values())
                _show({"job": name, "ok": not any(report.values()), "items": report})
        return int(bad)
    job = archive_job(spark, config, a.job)
    if a.command == "run":
        _show(job.export(now, dry_run=a.dry_run))
    elif a.command == "purge":
        done = job.purge(now, dry_run=a.dry_run)
        _show(done)
        return int(done.status == "verify-failed")
    elif a.command == "compact":
        for done in [job.compact(_day(a.dt))] if a.dt else job.compact_pending(now):
            _show(done)
    else:
        here = today(now, job.job.tz)
        yesterday = (date.fromisoformat(str(here)) - timedelta(days=1)).isoformat()
        first, last = _day(a.first) if a.first else job.earliest_day(), _day(a.last) if a.last else yesterday
        if first is None or first > last:
            _show({"days": {}, "rows": 0, "warnings": []})
            return 0
        if last >= str(here):
            print("The last day is not over; rows that come later are not in it.", file=sys.stderr)
        _show(job.backfill(first, last, a.force))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    a, secrets = parser().parse_args(argv), ()
    try:
        config = load(a.config)
        secrets = config.query_api.keys
        if a.command == "ps":
            r = urllib.request.Request(f"http://{config.query_api.listen}/admin/jobs", headers={"Authorization": f"Bearer {a.key}"})
            with urllib.request.urlopen(r, timeout=10) as f:
                emit(f.read().decode())
            return 0
        if a.command == "query" and a.isolate:
            p = isolated([sys.executable, "-m", "strandline", *[x for x in argv if x != "--isolate"]], a.timeout)
            sys.stdout.write(p.stdout)
            sys.stderr.write(redact(p.stderr, secrets) if p.returncode else "")
            return p.returncode
        log_to_stderr()
        return dispatch(spark or SparkSession.builder.appName("strandline").getOrCreate(), config, a)
    except (ConfigError, OutputError, FileNotFoundError) as e:
        code, why = 2, e
    except Refused as e:
        code, why = 1, e
    except (Q.Rejected, AnalysisException, ParseException) as e:
        code, why = 3, e
    except (Q.Timeout, Q.TooLarge, Killed) as e:
        code, why = 5, e
    except Exception as e:  # the engine's own failures, of many types
        code, why = 4, e
    print(json.dumps({"error": type(why).__name__, "message": redact(str(why).split("\n")[0], secrets)}), file=sys.stderr)
    return code
