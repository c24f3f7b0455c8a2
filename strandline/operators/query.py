"""Read-only SQL over registered views: gate, limits, deadline, rendering."""

from __future__ import annotations

import csv
import io
import json
import re
import threading
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

#: Logical nodes a query may consist of (names of Spark's classes).
PLAN_NODES = {"Project", "Filter", "Join", "LateralJoin", "Aggregate", "Sort", "Distinct", "GlobalLimit", "LocalLimit", "Offset", "Tail", "Union", "Intersect", "Except", "SubqueryAlias", "UnresolvedWith", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "UnresolvedInlineTable", "UnresolvedHaving", "WithWindowDefinition", "Window", "OneRowRelation", "LocalRelation", "Sample", "Pivot", "Generate", "Expand", "GroupingSets", "UnresolvedWithCTERelations", "Unpivot", "Limit", "ResolvedInlineTable", "UnresolvedTableValuedFunction"}
TABLE_FUNCTIONS = {"explode", "explode_outer", "posexplode", "inline", "range", "json_tuple", "stack"}
FORBIDDEN = {"reflect", "java_method", "try_reflect", "input_file_name", "input_file_block_start", "input_file_block_length", "current_catalog", "current_user", "user", "session_user", "version", "raise_error", "assert_true"}


class Rejected(ValueError):
    """The gate does not admit the statement."""


class Timeout(RuntimeError):
    pass


class TooLarge(RuntimeError):
    pass


def _children(node) -> list:
    seq = lambda s: [s.apply(i) for i in range(s.size())]
    return seq(node.children())


@dataclass
class Admitted:
    """What a statement reads: table names, the stretches of its text that name something in a database, and the days each table is asked for."""

    tables: set[str]
    #: (first character, last character, parts, whether it has an alias of its own; None: a column)
    names: list[tuple[int, int, list[str], bool | None]]
    days: dict[str, tuple[str | None, str | None]]


def check(spark: SparkSession, sql: str, tables: set[str], strict: bool = False) -> set[str]:
    return admitted(spark, sql, tables, strict).tables


def admitted(spark: SparkSession, sql: str, tables: set[str], strict: bool = False) -> Admitted:
    """What a single SELECT over registered tables reads; Rejected for anything else.

    strict: no table functions and no set operation on top.
    """
    if not strict and not re.match(r"(?is)\s*(select|with|from)\b", sql):
        raise Rejected("only SELECT is served")
    text = re.sub(r";\s*\Z", "", sql)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:
        raise Rejected("the statement does not parse") from e
    used: set[str] = set()
    names: list[tuple[int, int, list[str], bool | None]] = []
    asked: dict[str, list[tuple[str | None, str | None]]] = {}

    def placed(node, parts: list[str], alias: bool | None) -> None:
        o = node.origin()
        if o.startIndex().isDefined() and o.stopIndex().isDefined():
            names.append((o.startIndex().get(), o.stopIndex().get(), parts, alias))

    def seq(s) -> list:
        return [s.apply(i) for i in range(s.size())]

    def expression(e, scope: set[str]) -> None:
        name = e.getClass().getSimpleName()
        if name == "UnresolvedFunction":
            if seq(e.nameParts())[-1].lower() in FORBIDDEN or e.nameParts().size() > 1:
                raise Rejected("a function is not allowed")
        elif name == "UnresolvedAttribute":
            parts = [str(p) for p in seq(e.nameParts())]
            if any(p.lower() == "_metadata" for p in parts):
                raise Rejected("file metadata is not served")
            if len(parts) > 2 and ".".join(parts[:2]).lower() in tables:
                placed(e, parts, None)
        elif name in ("ExpressionWithUnresolvedIdentifier", "ScalarSubqueryWithUnresolvedIdentifier"):
            raise Rejected("IDENTIFIER() is not allowed")
        if hasattr(e, "plan") and name in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
            walk(e.plan(), scope)
        for c in seq(e.children()):
            expression(c, scope)

    def walk(p, scope: set[str], days: tuple = (None, None), alias: bool = False) -> None:
        """days: what the filters right above ask of the column dt; alias: whether the node's name is one."""
        name = p.getClass().getSimpleName()
        if name not in PLAN_NODES:
            raise Rejected(f"{name} is not allowed")
        if name == "UnresolvedWith":
            inner = set(scope)
            for pair in seq(p.cteRelations()):
                own = inner | ({pair._1().lower()} if p.allowRecursion() else set())
                walk(pair._2(), own)
                inner.add(pair._1().lower())
            scope = inner
        elif name == "UnresolvedRelation":
            parts = [str(x) for x in seq(p.multipartIdentifier())]
            key = ".".join(parts).lower()
            if len(parts) > 2:
                raise Rejected("names have two parts at most")
            if not (len(parts) == 1 and key in scope):
                if key not in tables:
                    raise Rejected("unknown table")
                used.add(key)
                asked.setdefault(key, []).append(days)
                if len(parts) == 2:
                    placed(p, parts, alias)
        elif name == "UnresolvedTableValuedFunction":
            if strict or seq(p.name())[-1].lower() not in TABLE_FUNCTIONS:
                raise Rejected("table functions are not allowed")
        for e in seq(p.expressions()):
            expression(e, scope)
        below = both(days, range_of(p.condition())) if name == "Filter" else days if name == "SubqueryAlias" else (None, None)
        for c in _children(p):
            walk(c, scope, below, name == "SubqueryAlias")

    def range_of(e) -> tuple[str | None, str | None]:
        """The days that a condition leaves: bounds that hold for every row it keeps."""
        name = e.getClass().getSimpleName()
        kids = seq(e.children())
        if name == "And":
            return both(range_of(kids[0]), range_of(kids[1]))
        if name in ("EqualTo", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual") and len(kids) == 2:
            turned = {"GreaterThan": "LessThan", "LessThan": "GreaterThan", "GreaterThanOrEqual": "LessThanOrEqual", "LessThanOrEqual": "GreaterThanOrEqual"}
            if _is_dt(kids[1]):
                kids, name = kids[::-1], turned.get(name, name)
            day = _literal_day(kids[1]) if _is_dt(kids[0]) else None
            return (None if name.startswith("Less") else day, None if name.startswith("Greater") else day)
        if name == "UnresolvedFunction" and [str(x).lower() for x in seq(e.nameParts())] == ["between"]:
            kids = seq(e.arguments())
        if name in ("Between", "UnresolvedFunction") and len(kids) == 3 and _is_dt(kids[0]):
            return (_literal_day(kids[1]), _literal_day(kids[2]))
        if name == "In" and _is_dt(kids[0]):
            found = [_literal_day(k) for k in kids[1:]]
            return (min(found), max(found)) if found and all(found) else (None, None)
        return (None, None)

    if strict and plan.getClass().getSimpleName() in ("Union", "Intersect", "Except", "Distinct"):
        raise Rejected("set operations on top are not allowed")
    walk(plan, set())
    days = {}
    for key, found in asked.items():  # a table that is read twice is asked for all its readers' days
        lows, highs = zip(*found, strict=True)
        days[key] = (None if None in lows else min(lows), None if None in highs else max(highs))
    return Admitted(used, names, days)


def both(a: tuple[str | None, str | None], b: tuple[str | None, str | None]) -> tuple[str | None, str | None]:
    return (max((x for x in (a[0], b[0]) if x), default=None), min((x for x in (a[1], b[1]) if x), default=None))


def _is_dt(e) -> bool:
    return e.getClass().getSimpleName() == "UnresolvedAttribute" and str(e.nameParts().last()).lower() == "dt"


def _literal_day(e) -> str | None:
    """The day of a literal such as DATE'2024-01-05' or '2024-01-05'; None for anything else."""
    m = re.fullmatch(r"(?:DATE ?)?'(\d{4}-\d{2}-\d{2})'", e.sql()) if e.getClass().getSimpleName() == "Literal" else None
    return m and m[1]


def renamed(sql: str, found: Admitted) -> str:
    """The statement with each database.table written as the one name its view has; nothing else of the text changes."""
    for a, b, parts, alias in sorted(found.names, reverse=True):
        quoted = [f"`{p.replace('`', '``')}`" for p in parts]
        view = f"`{'__'.join(parts[:2]).lower()}`"
        new = ".".join(quoted[1:]) if alias is None else view if alias else f"{view} AS {quoted[1]}"
        sql = sql[:a] + new + sql[b + 1 :]
    return sql


@dataclass
class Result:
    columns: list[str]
    types: list[str]
    rows: list[tuple]
    truncated: bool

    @property
    def row_count(self) -> int:
        return len(self.rows)


class Service:
    """Views by name, each query in a session of its own.

    A view is a DataFrame, or anything with ``read(first day, last day)``: an archive, which is then
    listed for each query, and only as far as the query's conditions on dt go.
    """

    def __init__(self, spark: SparkSession, views: dict[str, object], max_rows: int = 100_000, timeout_seconds: float = 60.0, max_bytes: int | None = None):
        self.spark, self.views, self.max_rows, self.timeout, self.max_bytes = spark, {k.lower(): v for k, v in views.items()}, max_rows, timeout_seconds, max_bytes

    def frame(self, name: str, days: tuple[str | None, str | None] = (None, None)) -> DataFrame:
        view = self.views[name]
        df = view.read(*days) if hasattr(view, "read") and not isinstance(view, DataFrame) else view
        if df is None:
            raise Rejected("nothing is archived yet")
        return df

    def run(self, sql: str, max_rows: int | None = None, timeout_seconds: float | None = None, strict: bool = False) -> Result:
        """One deadline covers the gate, the listing of files, planning and the run."""
        limit = min(max_rows or self.max_rows, self.max_rows)
        session = self.spark.newSession()
        for k, v in (("spark.sql.variable.substitute", "false"), ("spark.sql.runSQLOnFiles", "false"), ("spark.sql.session.timeZone", "UTC"), ("spark.sql.ansi.doubleQuotedIdentifiers", "true")):
            session.conf.set(k, v)
        text = re.sub(r";\s*\Z", "", sql)
        box: dict = {}

        def work() -> None:
            try:
                found = admitted(session, text, set(self.views), strict)
                for name in found.tables:
                    _in(session, self.frame(name, found.days[name])).createOrReplaceTempView(name.replace(".", "__"))
                df = session.sql(renamed(text, found))
                df = df.toDF(*unique(df.columns))
                box["schema"] = df.schema
                box["rows"] = df.limit(limit + 1).collect()
            except Exception as e:
                box["error"] = e

        t = threading.Thread(target=work, daemon=True)
        t.start()
        t.join(self.timeout if timeout_seconds is None else timeout_seconds)
        if t.is_alive():
            session.interruptAll()
            t.join(5)
            raise Timeout("the query took too long")
        if "error" in box:
            raise box["error"]
        rows = [tuple(r) for r in box["rows"][:limit]]
        if self.max_bytes is not None and sum(len(json.dumps(plain(list(r)), default=str)) for r in rows) > self.max_bytes:
            raise TooLarge("the result is too large")
        return Result([f.name for f in box["schema"].fields], [f.dataType.simpleString() for f in box["schema"].fields], rows, len(box["rows"]) > limit)


def _in(session: SparkSession, df: DataFrame) -> DataFrame:
    return DataFrame(session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, df._jdf.queryExecution().logical()), session)


def unique(names: list[str]) -> list[str]:
    """Repeated column names get _1, _2 ..."""
    seen, out, taken = Counter(), [], set(names)
    for n in names:
        new = n
        if seen[n]:
            k = seen[n]
            while (new := f"{n}_{k}") in taken:
                k += 1
            taken.add(new)
        seen[n] += 1
        out.append(new)
    return out


def plain(v):
    """A JSON value without loss: whole numbers beyond 32 bits, decimals and times become texts."""
    if isinstance(v, bool) or v is None or isinstance(v, (str, float)):
        return v
    if isinstance(v, int):
        return v if -(2**31) <= v < 2**31 else str(v)
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "asDict"):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {str(k): plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v.isoformat(sep=" ") if hasattr(v, "hour") else str(v)


def to_json(r: Result) -> str:
    return json.dumps({"columns": [{"name": n, "type": t} for n, t in zip(r.columns, r.types, strict=True)], "rows": [dict(zip(r.columns, map(plain, row), strict=True)) for row in r.rows], "rowCount": r.row_count, "truncated": r.truncated}, ensure_ascii=False)


def to_csv(r: Result, header: bool = True) -> str:
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\r\n")
    if header:
        w.writerow(r.columns)
    for row in r.rows:
        w.writerow(["" if v is None else json.dumps(p, ensure_ascii=False) if isinstance(p := plain(v), (list, dict)) else str(p).lower() if isinstance(p, bool) else p for v in row])
    return out.getvalue()


_META = re.compile(r"(?is)\s*(?:(show)\s+(databases|tables)(?:\s+(?:from|in)\s+[`\"]?(\w+)[`\"]?)?|(?:describe|desc|show\s+(?:columns|fields)\s+(?:from|in))\s+[`\"]?(\w+)[`\"]?\.[`\"]?(\w+)[`\"]?)\s*;?\s*")


def meta(service: Service, sql: str) -> list[tuple] | None:
    """Answers to SHOW DATABASES, SHOW TABLES [FROM db], DESCRIBE db.table and their kin; None if it is a query."""
    if not re.match(r"(?i)\s*(show|desc|describe)\b", sql):
        return None
    m = _META.fullmatch(sql)
    if not m:
        raise Rejected("this SHOW or DESCRIBE is not supported")
    names = sorted(n for n in service.views if "." in n)
    if m[1]:
        if m[2].lower() == "databases":
            return [(d,) for d in sorted({n.split(".")[0] for n in names})]
        return [tuple(n.split(".")) for n in names if not m[3] or n.split(".")[0] == m[3].lower()]
    key = f"{m[4]}.{m[5]}".lower()
    if key not in service.views:
        raise Rejected("unknown table")
    return [(f.name, f.dataType.simpleString()) for f in service.frame(key).schema.fields]
