"""Reading the archive: live files, one schema, day pruning."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.naming import ArchiveFile, live, overlapping
from .files import Store

_LADDERS = ([T.ByteType, T.ShortType, T.IntegerType, T.LongType], [T.FloatType, T.DoubleType])


#: Of rows that repeat an id: data files before incremental ones, then the greater name.
PREFERRED = ["split(_file, '-')[0] ASC", "_file DESC"]


class SchemaConflict(ValueError):
    pass


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both without loss; SchemaConflict if none does."""
    if a == b:
        return a
    for ladder in _LADDERS:
        if type(a) in ladder and type(b) in ladder:
            return a if ladder.index(type(a)) > ladder.index(type(b)) else b
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    as_decimal = lambda t: t if isinstance(t, T.DecimalType) else T.DecimalType(whole[type(t)], 0) if type(t) in whole else None
    x, y = as_decimal(a), as_decimal(b)
    if x and y:
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise SchemaConflict(f"{a.simpleString()} and {b.simpleString()} have no common type")


def union_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    fields: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


class Archive:
    def __init__(self, spark: SparkSession, root: str, cursor: str):
        self.spark, self.cursor = spark, cursor
        self.store = Store(spark, root)

    def files(self) -> list[ArchiveFile]:
        return self.store.files()

    def _scan(self, files: list[ArchiveFile]) -> DataFrame:
        return self.spark.read.option("basePath", self.store.root).option("mergeSchema", "true").parquet(*[f.path for f in files])

    def _alike(self, files: list[ArchiveFile]) -> list[tuple[list[ArchiveFile], DataFrame]]:
        """Files in runs whose schemas Spark can merge, each with its scan.

        Spark reads a run's footers in one distributed pass; only where types
        differ is the run halved, so drift costs passes by its changes, not by files.
        """
        try:
            return [(files, self._scan(files))]
        except (PySparkException, Py4JJavaError):
            if len(files) == 1:
                raise
        half = len(files) // 2
        return self._alike(files[:half]) + self._alike(files[half:])

    def read_files(self, files: list[ArchiveFile], name: str | None = None) -> DataFrame:
        """Exactly these files with their day, cast to the union of their schemas; ``name``: a column for the file's name."""
        runs: dict[str, tuple[list[ArchiveFile], DataFrame]] = {}
        for some, df in self._alike(sorted(files, key=lambda f: (f.from_id, f.path))):
            key = df.schema.json()
            runs[key] = ([*runs[key][0], *some], runs[key][1]) if key in runs else (some, df)
        schemas = {k: T.StructType([x for x in df.schema.fields if x.name != "dt"]) for k, (_, df) in runs.items()}
        union = union_schema(schemas.values())
        parts = []
        for k, (some, df) in runs.items():
            df = self._scan(some)
            have = set(schemas[k].names)
            more = [F.col("_metadata.file_name").alias(name)] if name else []
            parts.append(df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in union.fields], F.col("dt").cast("date").alias("dt"), *more))
        return reduce(DataFrame.unionByName, parts)

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame | None:
        """The archive, or its days first..last; each id once.  None if nothing was ever archived.

        Folders outside the days are neither listed nor opened.
        """
        every = self.store.days()
        files = self.store.files(None if first is None and last is None else [d for d in every if (first is None or d >= first) and (last is None or d <= last)])
        if not files:
            for day in reversed(every):  # the newest day that has a file knows the schema
                if known := self.store.files([day]):
                    return self.read_files([self.latest(known)]).where(F.lit(False))
            return None
        some = live(files)
        if not overlapping(some):
            return self.read_files(some)
        return first_of_each(self.read_files(some, "_file"), self.cursor, PREFERRED).drop("_file")

    @staticmethod
    def latest(files: list[ArchiveFile]) -> ArchiveFile:
        """The file that knows the newest schema."""
        return max(files, key=lambda f: (f.to_id, f.name))


def first_of_each(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row of each key, the first in ``order`` (columns or expressions, ASC or DESC); rows that tie there are told apart by their content."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    by = [F.expr(o.removesuffix(" DESC")).desc() if o.endswith(" DESC") else F.expr(o.removesuffix(" ASC")).asc() for o in order]
    w = Window.partitionBy(key).orderBy(*by, tie)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
