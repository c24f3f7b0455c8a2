"""Staged writes with exact file names.

One job writes every segment to a hidden folder, one file each; renames in id
order then make them visible, so whatever a crash leaves is a gapless prefix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import file_name
from ..sources.archive import Archive


@dataclass(frozen=True)
class Segment:
    seg: int
    dt: str
    min_id: int
    max_id: int
    rows: int


def write(archive: Archive, df: DataFrame, segments: list[Segment], kind: str, on_file: Callable[[Segment, str], None] | None = None, check: Callable[[Segment, str], None] | None = None) -> list[str]:
    """Write df (columns, dt, seg) as one file a segment; names of the files, in id order.

    ``check`` sees each staged file before any is published, and may raise.
    """
    if any(s.dt is None for s in segments):
        raise ValueError("rows without a time cannot be filed under a day")
    store, stage = archive.store, f"{archive.store.root}/_stage-{uuid.uuid4().hex}"
    out: list[str] = []
    try:
        n = max(1, min(len(segments), 200))
        rows = df.drop("dt").repartition(n, "seg").sortWithinPartitions("seg", archive.cursor)
        rows.write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy("seg").parquet(stage)
        staged: list[tuple[Segment, str]] = []
        for s in sorted(segments, key=lambda s: s.min_id):
            parts = store.parts(f"{stage}/seg={s.seg}")
            if len(parts) != 1:
                raise RuntimeError(f"segment {s.seg} was written as {len(parts)} files")
            staged.append((s, parts[0]))
            if check:
                check(s, parts[0])
        for s, part in staged:
            name = f"{store.root}/dt={s.dt}/{file_name(kind, s.min_id, s.max_id)}"
            store.rename(part, name)
            out.append(name)
            if on_file:
                on_file(s, name)
    finally:
        store.delete(stage)
    return out


def numbered(df: DataFrame, key: str = "dt") -> DataFrame:
    """seg = a number for each day, for writes of one file a day."""
    return df.withColumn("seg", F.datediff(F.col(key).cast("date"), F.lit("1970-01-01").cast("date")))
