"""Export, compaction, purge, backfill, status and checks of one archive job.

``now`` is always an argument.  The high-water mark is rebuilt from file names
at every call; there is no other state.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.config import RESERVED, Job
from ..functions.naming import file_name, high_water, pending_days
from ..functions.times import Before, compared, day_of, in_days, today
from ..plans import relational as R
from ..sources.archive import PREFERRED, Archive, first_of_each
from ..sources.hot import HotTable, WritersActive
from .writer import Segment, numbered, write


class Refused(RuntimeError):
    """An operation that would break the archive's guarantees."""


@dataclass
class ExportResult:
    status: str  # ok, empty, stalled, dry-run
    rows: int = 0
    from_id: int | None = None
    to_id: int | None = None
    files: list[str] = field(default_factory=list)
    lag: int = 0


@dataclass
class CompactResult:
    status: str  # ok, skip
    dt: str
    rows: int = 0
    file: str | None = None
    merged: int = 0


@dataclass
class PurgeResult:
    status: str  # ok, empty, dry-run, verify-failed
    eligible: int = 0
    deleted: int = 0
    batches: int = 0
    missing: int = 0
    first_missing: int | None = None


@dataclass
class BackfillResult:
    days: dict[str, str] = field(default_factory=dict)  # ok, empty, skip
    rows: int = 0
    warnings: list[str] = field(default_factory=list)


@dataclass
class JobStatus:
    high_water: int | None
    files: int
    bytes: int
    lag: int
    rows_per_second: float | None
    eta_seconds: float | None
    pending: list[str]


class ArchiveJob:
    def __init__(self, spark: SparkSession, job: Job, hot: HotTable):
        self.spark, self.job, self.hot = spark, job, hot
        self.archive = Archive(spark, job.prefix, job.cursor)

    # predicates -------------------------------------------------------------
    def day(self) -> Column:
        return day_of(F.col(self.job.time_column), self.job.encoding, self.job.tz)

    def _before(self, at: datetime) -> Column:
        return compared(self.job.time_column, "<", at, self.job.encoding, self.job.tz)

    def expired(self, now: datetime) -> Before:
        return Before(self.job.time_column, now - timedelta(seconds=self.job.retain_seconds), self.job.encoding, self.job.tz)

    # export -----------------------------------------------------------------
    def export(self, now: datetime, dry_run: bool = False, on_file: Callable | None = None) -> ExportResult:
        job, c = self.job, self.job.cursor
        mark, rows, bound = high_water(self.archive.files()), self.hot.scan(), None
        cap = None
        if job.guard:
            try:
                cap = self.hot.write_guard(job.safety_lag_seconds)
            except WritersActive:
                return ExportResult("stalled")
            if cap is not None and mark is not None and cap <= mark:
                return ExportResult("stalled")
        if cap is not None:
            rows = rows.where(F.col(c) <= cap)
        if job.safety_lag_seconds > 0:
            bound = R.safe_bound(rows, c, self._before(now - timedelta(seconds=job.safety_lag_seconds)), mark, job.export_rows).first().bound
            if bound is None:
                return ExportResult("empty")
        bound = min((x for x in (bound, cap) if x is not None), default=None)
        some = self.hot.batch(mark, bound, job.export_rows)
        if dry_run:
            s = R.summary(some, c).first()
            return ExportResult("dry-run" if s.n else "empty", s.n, s.min_id, s.max_id)
        cut = R.segments(some, c, self.day()).persist()
        try:
            spans = [Segment(int(r.seg), r.dt, int(r.min_id), int(r.max_id), int(r.n)) for r in cut.groupBy("seg", "dt").agg(F.min(c).alias("min_id"), F.max(c).alias("max_id"), F.count("*").alias("n")).orderBy("min_id").collect()]
            if not spans:
                return ExportResult("empty")
            files = write(self.archive, cut, spans, "inc", on_file)
        finally:
            cut.unpersist()
        top = spans[-1].max_id
        lag = self.hot.scan().where(F.col(c) > top).count()
        return ExportResult("ok", sum(s.rows for s in spans), spans[0].min_id, top, files, lag)

    # compaction ---------------------------------------------------------------
    def compact(self, dt: str) -> CompactResult:
        files = [f for f in self.archive.files() if f.dt == dt]
        if not files or (len(files) == 1 and files[0].kind == "data"):
            return CompactResult("skip", dt)
        low, top = min(f.from_id for f in files), max(f.to_id for f in files)
        target = f"{self.archive.store.root}/dt={dt}/{file_name('data', low, top)}"
        if len(files) == 1:
            self.archive.store.rename(files[0].path, target)
            return CompactResult("ok", dt, file=target, merged=1)
        rows, c = self.archive.read_files(files, "_file"), self.job.cursor
        expected = rows.agg(F.countDistinct(c)).first()[0]
        merged = first_of_each(rows, c, PREFERRED).drop("_file", "dt").withColumn("dt", F.lit(dt)).withColumn("seg", F.lit(0))

        def counted(segment: Segment, staged: str) -> None:
            got = self.spark.read.parquet(staged).count()
            if got != expected:
                raise Refused(f"{dt}: {got} rows merged, {expected} expected; nothing is published, the sources stay")

        write(self.archive, merged, [Segment(0, dt, low, top, expected)], "data", check=counted)
        for f in files:
            if f.path != target:
                self.archive.store.delete(f.path)
        return CompactResult("ok", dt, expected, target, len(files))

    def compact_pending(self, now: datetime) -> list[CompactResult]:
        return [self.compact(d) for d in pending_days(self.archive.files(), today(now, self.job.tz))]

    # purge ----------------------------------------------------------------------
    def purge(self, now: datetime, dry_run: bool = False, sleep: Callable[[float], None] = time.sleep) -> PurgeResult:
        job, c = self.job, self.job.cursor
        files = self.archive.files()
        mark = high_water(files)
        if mark is None:
            return PurgeResult("empty")
        old = self.expired(now)
        rows = self.hot.scan().where(old.column() & (F.col(c) <= mark))
        s = R.summary(rows, c).first()
        if not s.n:
            return PurgeResult("empty")
        if dry_run:
            return PurgeResult("dry-run", s.n)
        if job.verify:
            some = [f for f in files if f.to_id >= s.min_id and f.from_id <= s.max_id]
            archived = self.archive.read_files(some).where(F.col(c).between(s.min_id, s.max_id)) if some else rows.where(F.lit(False))
            m = R.missing(rows, archived, c).first()
            if m.missing:
                return PurgeResult("verify-failed", s.n, missing=m.missing, first_missing=m.first_missing)
        deleted = batches = 0
        while n := self.hot.delete(s.max_id, old, job.delete_rows):
            deleted, batches = deleted + n, batches + 1
            if job.delete_sleep_ms:
                sleep(job.delete_sleep_ms / 1000)
        return PurgeResult("ok", s.n, deleted, batches)

    # backfill ---------------------------------------------------------------------
    def gap(self, first: str, last: str) -> int:
        """Rows outside the days that a backfill of them would let the high-water mark pass over."""
        job, c, mark = self.job, self.job.cursor, high_water(self.archive.files())
        rows, inside = self.hot.scan(), in_days(job.time_column, first, last, job.encoding, job.tz)
        top = rows.where(inside).agg(F.max(c)).first()[0]
        if top is None:
            return 0
        return rows.where(~inside & (F.lit(True) if mark is None else F.col(c) > mark) & (F.col(c) <= top)).count()

    def backfill(self, first: str, last: str, force: bool = False, on_day: Callable[[str, int, int], None] | None = None) -> BackfillResult:
        """``on_day`` hears of each day as its file is published: the day, its rows, and how many rows are done."""
        job, c = self.job, self.job.cursor
        files = self.archive.files()
        mark, rows, out = high_water(files), self.hot.scan(), BackfillResult()
        inside = in_days(job.time_column, first, last, job.encoding, job.tz)
        if rows.where(inside).isEmpty():
            out.days = {d: "empty" for d in _days(first, last)}
            return out
        above = F.lit(True) if mark is None else F.col(c) > mark
        gap = self.gap(first, last)
        if gap and not force:
            raise Refused(f"{gap} rows outside the days would be passed over by the high-water mark")
        spans = R.day_spans(rows.where(inside), c, self.day())
        out.warnings = [f"ids of {r.before_dt} and {r.dt} interleave" for r in R.overlaps(spans).collect()]
        by_day = {r.dt: r for r in spans.collect()}
        todo: list[Segment] = []
        for d in _days(first, last):
            have = [f for f in files if f.dt == d]
            if d not in by_day:
                out.days[d] = "skip" if have else "empty"
            elif have:
                left = rows.where(in_days(job.time_column, d, d, job.encoding, job.tz) & above).count()
                if left:
                    raise Refused(f"{d} is archived in part: {left} rows are not")
                out.days[d] = "skip"
            else:
                r = by_day[d]
                todo.append(Segment((date.fromisoformat(d) - date(1970, 1, 1)).days, d, int(r.min_id), int(r.max_id), int(r.n)))
                out.days[d], out.rows = "ok", out.rows + int(r.n)
        if todo:
            some = rows.where(inside).withColumn("dt", self.day()).where(F.col("dt").isin([s.dt for s in todo]))
            done = 0

            def published(segment: Segment, name: str) -> None:
                nonlocal done
                done += segment.rows
                if on_day:
                    on_day(segment.dt, segment.rows, done)

            write(self.archive, numbered(some), todo, "data", published)
        return out

    def earliest_day(self) -> str | None:
        return self.hot.scan().agg(F.min(self.day())).first()[0]

    # status and checks ---------------------------------------------------------------
    def status(self, now: datetime) -> JobStatus:
        files = self.archive.files()
        mark = high_water(files)
        entries = {e.path: e for e in self.archive.store.list()}
        c = self.job.cursor
        lag = self.hot.scan().where(F.lit(True) if mark is None else F.col(c) > mark).count()
        rate = throughput([(entries[f.path].modified_ms / 1000, f.from_id, f.to_id) for f in files if f.kind == "inc" and f.path in entries], now.timestamp())
        return JobStatus(mark, len(files), sum(entries[f.path].size for f in files if f.path in entries), lag, rate, lag / rate if rate else None, pending_days(files, today(now, self.job.tz)))

    def check(self) -> dict[str, str]:
        """Problems by item; an empty text is a pass."""
        job, df = self.job, self.hot.scan()
        types = {f.name: f.dataType for f in df.schema.fields}
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        out = {"cursor": "", "unique": "", "time": "", "not null": "", "reserved": "", "cursor null": "", "archive": ""}
        if not isinstance(types.get(job.cursor), whole):
            out["cursor"] = "the cursor is no integer column"
        elif df.groupBy(job.cursor).count().where("count > 1").limit(1).count():
            out["unique"] = "the cursor repeats"
        if job.cursor in types and df.where(F.col(job.cursor).isNull()).limit(1).count():
            out["cursor null"] = "the cursor has nulls"
        if job.time_column not in types:
            out["time"] = "no such time column"
        else:
            if isinstance(types[job.time_column], whole) != job.encoding.startswith("unix"):
                out["time"] = f"the time column is not {job.encoding}"
            if df.where(F.col(job.time_column).isNull()).limit(1).count():
                out["not null"] = "the time column has nulls"
        if RESERVED & set(types):
            out["reserved"] = "reserved column names in use"
        try:
            self.archive.files()
        except Exception as e:  # the store's own exceptions differ by store
            out["archive"] = type(e).__name__
        return out


def throughput(files: list[tuple[float, int, int]], now: float) -> float | None:
    """Ids a second over the last hour's incremental files (time, from, to); it takes two.  Gaps in ids count as rows."""
    last = sorted(f for f in files if now - 3600 <= f[0] <= now)
    if len(last) < 2 or last[-1][0] <= last[0][0]:
        return None
    return sum(b - a + 1 for _, a, b in last) / (last[-1][0] - last[0][0])


def _days(first: str, last: str) -> list[str]:
    a, b = date.fromisoformat(first), date.fromisoformat(last)
    return [(a + timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]

