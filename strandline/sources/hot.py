"""Online tables: a Parquet snapshot with copy-on-write deletes, and JDBC."""

from __future__ import annotations

import time
import uuid
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import Before
from ..plans.relational import batch
from .files import Store


class WritersActive(RuntimeError):
    """A transaction that may hold small ids is still open."""


class HotTable(Protocol):
    cursor: str

    def scan(self) -> DataFrame: ...
    def batch(self, above: int | None, bound: int | None, limit: int) -> DataFrame: ...
    def delete(self, bound: int, old: Before, limit: int) -> int: ...
    def write_guard(self, wait_seconds: float = 0) -> int | None:
        """The largest id below which nothing can still be committed; None: no bound is needed.  WritersActive: not now."""


class FixedTable:
    """A table that is only read: any DataFrame."""

    def __init__(self, df: DataFrame, cursor: str):
        self.df, self.cursor = df, cursor

    def scan(self) -> DataFrame:
        return self.df

    def batch(self, above: int | None, bound: int | None, limit: int) -> DataFrame:
        return batch(self.df, self.cursor, above, bound, limit)

    def delete(self, bound: int, old: Before, limit: int) -> int:
        raise NotImplementedError("this table is only read")

    def write_guard(self, wait_seconds: float = 0) -> int | None:
        return None


class ParquetHotTable:
    """A folder of snapshots; the newest complete one is the table."""

    def __init__(self, spark: SparkSession, root: str, cursor: str):
        self.spark, self.root, self.cursor = spark, root.rstrip("/"), cursor
        self.store = Store(spark, self.root)

    def replace(self, df: DataFrame) -> None:
        old = self._snapshots()
        n = 1 + max((int(s.rsplit("v", 1)[1].split("-")[0]) for s in old), default=0)
        df.write.parquet(f"{self.root}/v{n:08d}-{uuid.uuid4().hex[:8]}")
        for s in old:
            self.store.delete(s)

    def _snapshots(self) -> list[str]:
        return sorted({e.path.rsplit("/", 1)[0] for e in self.store.list() if e.path.endswith("/_SUCCESS")})

    def scan(self) -> DataFrame:
        return self.spark.read.parquet(self._snapshots()[-1])

    def delete(self, bound: int, old: Before, limit: int) -> int:
        """Delete up to ``limit`` rows with the smallest ids among the ``old`` ones up to ``bound``."""
        rows = self.scan()
        some = rows.where((F.col(self.cursor) <= bound) & old.column())
        gone = some.select(self.cursor).orderBy(self.cursor).limit(limit)
        n = gone.count()
        if n:
            self.replace(rows.join(gone, self.cursor, "left_anti"))
        return n

    def batch(self, above: int | None, bound: int | None, limit: int) -> DataFrame:
        return batch(self.scan(), self.cursor, above, bound, limit)

    def write_guard(self, wait_seconds: float = 0) -> int | None:
        return None  # a snapshot is complete


class JdbcHotTable:
    """A table behind JDBC; filters and limits are sent as subquery text."""

    #: Ids a connection reads, at least; connections a batch takes, at most.
    SHARE, CONNECTIONS = 50_000, 16

    def __init__(self, spark: SparkSession, url: str, table: str, cursor: str, dialect: str = "mysql", **options: str):
        self.spark, self.url, self.cursor, self.dialect, self.options = spark, url, cursor, dialect, options
        self.name, self.table = table, ".".join(self.quote(x) for x in table.split("."))

    def quote(self, name: str) -> str:
        q = "`" if self.dialect == "mysql" else '"'
        return q + name.replace(q, q * 2) + q

    def limit(self, n: int) -> str:
        return f"LIMIT {n}" if self.dialect == "mysql" else f"FETCH FIRST {n} ROWS ONLY"

    def range_sql(self, above: int | None, bound: int | None, n: int, columns: str = "*") -> str:
        c = self.quote(self.cursor)
        where = " AND ".join([f"{c} > {above}"] * (above is not None) + [f"{c} <= {bound}"] * (bound is not None)) or "1 = 1"
        return f"SELECT {columns} FROM {self.table} WHERE {where} ORDER BY {c} {self.limit(n)}"

    def delete_sql(self, bound: int, where: str, n: int) -> str:
        c = self.quote(self.cursor)
        if self.dialect == "mysql":
            return f"DELETE FROM {self.table} WHERE {c} <= {bound} AND ({where}) ORDER BY {c} LIMIT {n}"
        return f"DELETE FROM {self.table} WHERE {c} IN (SELECT {c} FROM {self.table} WHERE {c} <= {bound} AND ({where}) ORDER BY {c} {self.limit(n)})"

    def scan(self, sql: str | None = None) -> DataFrame:
        return self.spark.read.format("jdbc").option("url", self.url).option("dbtable", f"({sql}) t" if sql else self.table).options(**self.options).load()

    def batch(self, above: int | None, bound: int | None, limit: int) -> DataFrame:
        """The next rows in cursor order: the database finds their last id, then connections share the range of ids."""
        c = self.quote(self.cursor)
        lo, hi = (self.value(f"SELECT {f}({c}) FROM ({self.range_sql(above, bound, limit, c)}) t") for f in ("MIN", "MAX"))
        if hi is None:
            return self.scan(f"SELECT * FROM {self.table} WHERE 1 = 0")
        n = max(1, min(self.CONNECTIONS, (hi - lo) // self.SHARE))
        read = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", f"(SELECT * FROM {self.table} WHERE {c} >= {lo} AND {c} <= {hi}) t").options(**self.options)
        if n > 1:
            read = read.option("partitionColumn", self.cursor).option("lowerBound", lo).option("upperBound", hi + 1).option("numPartitions", n)
        return read.load()

    def _connected(self, work):
        properties = self.spark._jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, str(v))
        conn = self.spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            return work(conn.createStatement())
        finally:
            conn.close()

    def column(self, sql: str, first: str | None = None) -> list:
        """The first column of a query's rows, as texts; ``first`` is executed before, on the same connection."""

        def work(statement) -> list:
            if first:
                statement.execute(first)
            rows, out = statement.executeQuery(sql), []
            while rows.next():
                out.append(rows.getString(1))
            return out

        return self._connected(work)

    def value(self, sql: str, first: str | None = None) -> int | None:
        found = self.column(sql, first)
        return int(found[0]) if found and found[0] is not None else None

    def delete(self, bound: int, old: Before, limit: int) -> int:
        """As above, in the database; each call commits on its own."""
        return self._connected(lambda s: s.executeUpdate(self.delete_sql(bound, old.sql(self.quote(old.name)), limit)))

    def open_writers(self) -> set[str]:
        """Transactions that wrote rows, or wait for a lock and may hold an id already."""
        return set(self.column("SELECT trx_id FROM information_schema.innodb_trx WHERE trx_rows_modified > 0 OR trx_state = 'LOCK WAIT'"))

    def write_guard(self, wait_seconds: float = 0, sleep=time.sleep) -> int | None:
        """Ids below the next one to be given out are all taken; those not committed belong to transactions open now.

        Once these have ended, everything below is settled.  The list of
        transactions is refreshed every 0.1 s, so it is read a little after the id.
        """
        if self.dialect != "mysql":
            return None
        *schema, table = [x.replace("'", "''") for x in self.name.split(".")]
        place = f"'{schema[0]}'" if schema else "DATABASE()"
        given = self.value(f"SELECT AUTO_INCREMENT FROM information_schema.TABLES WHERE TABLE_SCHEMA = {place} AND TABLE_NAME = '{table}'", "SET SESSION information_schema_stats_expiry = 0")
        if given is None:
            raise ValueError(f"{self.name} gives out no ids by itself: switch the guard off for it")
        sleep(0.2)
        if before := self.open_writers():
            sleep(min(wait_seconds, 30))
            if before & self.open_writers():
                raise WritersActive(self.name)
        return given - 1
