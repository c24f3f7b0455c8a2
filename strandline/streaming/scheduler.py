"""Polled micro-batches: interval export, daily compaction then purge.

Not Structured Streaming: its watermark drops late rows and its checkpoint is
state outside the archive; here offsets are file names, and no row is dropped.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from zoneinfo import ZoneInfo

from ..functions.times import utc_now
from ..operators.jobs import ArchiveJob


@dataclass
class RunState:
    state: str = "idle"
    last_result: object = None
    error: str | None = None
    started_at: datetime | None = None
    finished_at: datetime | None = None


@dataclass
class Registry:
    states: dict[tuple[str, str], RunState] = field(default_factory=dict)
    lock: threading.Lock = field(default_factory=threading.Lock)

    def run(self, job: str, kind: str, action: Callable[[], object]) -> bool:
        """Run and record; an exception is kept, never raised, so one job cannot stop the loop."""
        with self.lock:
            s = self.states.setdefault((job, kind), RunState())
            if s.state == "running":
                return False  # no overlap
            s.state, s.started_at, s.error = "running", utc_now(), None
        try:
            s.last_result = action()
            return True
        except Exception as e:
            s.error = f"{type(e).__name__}: {e}"
            return False
        finally:
            s.state, s.finished_at = "idle", utc_now()

    def snapshot(self) -> list[dict]:
        with self.lock:
            return [{"job": j, "kind": k, "state": s.state, "error": s.error, "started_at": s.started_at, "finished_at": s.finished_at} for (j, k), s in sorted(self.states.items())]


def daily(job: ArchiveJob, registry: Registry, now: datetime) -> None:
    """Compact every pending day; purge only if all went well and purging has no interval of its own."""
    ok = registry.run(job.job.name, "compact", lambda: job.compact_pending(now))
    if ok and job.job.purge_interval_seconds is None:
        registry.run(job.job.name, "purge", lambda: job.purge(now))


def next_due(due: float, every: float, now: float) -> float:
    """When the next round is due: a multiple of ``every`` after the last, so rounds don't drift; missed ones are passed over."""
    return due + every * max(1, -(-(now - due) // every))


def serve(jobs: list[ArchiveJob], stop: threading.Event, registry: Registry | None = None, clock: Callable[[], datetime] = utc_now) -> Registry:
    """Blocks until ``stop``; a running batch is waited for."""
    registry = registry or Registry()

    def loop(job: ArchiveJob, kind: str, every: float, action: Callable[[], object]) -> None:
        due = time.monotonic()
        while not stop.is_set():
            registry.run(job.job.name, kind, action)
            due = next_due(due, every, time.monotonic())
            stop.wait(max(0.0, due - time.monotonic()))

    def at_time(job: ArchiveJob) -> None:
        done = None
        while not stop.is_set():
            local = clock().astimezone(ZoneInfo(job.job.tz))
            if local.strftime("%H:%M") >= job.job.compact_at and done != local.date():
                done = local.date()
                daily(job, registry, clock())
            stop.wait(min(30.0, job.job.interval_seconds))

    threads = []
    for j in jobs:
        threads.append(threading.Thread(target=loop, args=(j, "export", j.job.interval_seconds, lambda j=j: j.export(clock()))))
        threads.append(threading.Thread(target=at_time, args=(j,)))
        if j.job.purge_interval_seconds:
            threads.append(threading.Thread(target=loop, args=(j, "purge", j.job.purge_interval_seconds, lambda j=j: j.purge(clock()))))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return registry
