"""Relational pieces the archive operators are made of, each a plain DataFrame plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed


def batch(df: DataFrame, cursor: str, above: int | None, bound: int | None, limit: int) -> DataFrame:
    """The next rows in cursor order (TakeOrderedAndProject); above None: from the start."""
    if above is not None:
        df = df.where(F.col(cursor) > above)
    if bound is not None:
        df = df.where(F.col(cursor) <= bound)
    return df.orderBy(cursor).limit(limit)


def segments(df: DataFrame, cursor: str, day: Column) -> DataFrame:
    """Rows with dt and seg: runs of equal days in cursor order.

    The window is global: for one export's batch, which is bounded.
    """
    w = Window.orderBy(cursor)
    df = df.withColumn("dt", day)
    change = F.when(F.col("dt") == F.lag("dt").over(w), 0).otherwise(1)
    return df.withColumn("_c", change).withColumn("seg", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def segment_spans(df: DataFrame, cursor: str, day: Column) -> DataFrame:
    """seg, dt, min_id, max_id, n of a table of any size.

    Islands are cut inside ranges of ids, each its own window, and ranges' edge
    islands are stitched: only the few edge rows meet in one task.
    """
    rows = df.select(F.col(cursor).cast("long").alias("id"), day.alias("dt")).repartitionByRange("id")
    rows = rows.withColumn("p", F.spark_partition_id())
    w = Window.partitionBy("p").orderBy("id")
    flag = F.when(F.col("dt").eqNullSafe(F.lag("dt").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    local = rows.withColumn("c", flag).withColumn("s", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isles = local.groupBy("p", "s", "dt").agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count("*").alias("n"))
    g = Window.orderBy("min_id")
    joined = isles.withColumn("c", F.when(F.col("dt").eqNullSafe(F.lag("dt").over(g)) & (F.row_number().over(g) > 1), 0).otherwise(1))
    joined = joined.withColumn("seg", F.sum("c").over(g.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy("seg", "dt").agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), F.sum("n").alias("n"))


def day_spans(df: DataFrame, cursor: str, day: Column) -> DataFrame:
    return df.groupBy(day.alias("dt")).agg(F.min(cursor).alias("min_id"), F.max(cursor).alias("max_id"), F.count("*").alias("n"))


def overlaps(spans: DataFrame) -> DataFrame:
    """Adjacent days whose id ranges overlap; one row a day goes in."""
    w = Window.orderBy("dt")
    out = spans.withColumn("before_dt", F.lag("dt").over(w)).withColumn("before_max", F.lag("max_id").over(w))
    return out.where("before_max >= min_id").select("before_dt", "dt", "before_max", "min_id")


def safe_bound(df: DataFrame, cursor: str, old: Column, above: int | None, limit: int) -> DataFrame:
    """The largest id to export so that ``limit`` rows past the safety line go: younger rows below it go too."""
    return batch(df.where(old), cursor, above, None, limit).agg(F.max(cursor).alias("bound"))


def summary(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.min(cursor).alias("min_id"), F.max(cursor).alias("max_id"))


def missing(candidates: DataFrame, archived: DataFrame, cursor: str) -> DataFrame:
    """How many candidates the archive lacks, and the first: a left anti join on the id alone."""
    return candidates.select(cursor).join(archived.select(cursor), cursor, "left_anti").agg(F.count("*").alias("missing"), F.min(cursor).alias("first_missing"))


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str], columns: list[str]) -> DataFrame:
    """Each left row with ``columns`` of the last right row at or before it: a union and a window, no pairs.

    A shuffle on ``by`` and one sort; right rows that tie are ordered by their columns, the largest wins.
    """
    l_cols = left.columns
    a = left.select(F.struct(*l_cols).alias("l"), F.col(on).alias("_t"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.lit(None).cast(right.select(F.struct(*columns)).schema[0].dataType).alias("r"), F.lit(1).alias("_o"))
    b = right.select(F.lit(None).cast(a.schema["l"].dataType).alias("l"), F.col(on).alias("_t"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.struct(*columns).alias("r"), F.lit(0).alias("_o"))
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(by))]).orderBy("_t", "_o", "r").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("r", F.last("r", ignorenulls=True).over(w)).where("_o = 1").select("l.*", *[F.col(f"r.{c}").alias(f"right_{c}") for c in columns])


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in a total order of any size: ranges are sorted and counted in parallel, one row a range gives each its first number."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    rows = checkpointed(rows.withColumn("_i", F.col("_m") - F.shiftleft(F.col("_p").cast("long"), 33)).drop("_m"))  # ranges are sampled: they must not be dealt twice
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return rows.join(F.broadcast(before), "_p").withColumn(name, F.col("_i") + F.col("_b")).drop("_p", "_i", "_b")  # one row a partition


def positional_join(left: DataFrame, l_order: list[str], right: DataFrame, r_order: list[str]) -> DataFrame:
    """Rows side by side: the first of each order, the second, and so on; the longer side goes on beside nulls.  Orders must be total."""
    return numbered(left, l_order, "_at").join(numbered(right, r_order, "_at"), "_at", "full").drop("_at")
