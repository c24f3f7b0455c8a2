"""Neighbours in a sorted order, verification of candidate links, connected components."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import settle, tidy


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node in ``links`` (u, v: long).

    Alternating large-star and small-star steps; each is two aggregations and two
    joins over the links, nothing goes to the driver but a count and a checksum.
    """
    edges = settle(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not state.n or (state.n, state.s) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        before = (state.n, state.s)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


class Ranges:
    """Ranges of the order of three long columns, cut at equal steps through a sample of them."""

    def __init__(self, sample: list[np.ndarray], parts: int):
        order = np.lexsort(sample[::-1])
        at = order[np.arange(1, parts) * len(order) // parts] if len(order) else order
        self.cuts = [c[at] for c in sample]

    def part(self, columns: list[np.ndarray]) -> np.ndarray:
        """How many cuts stand at or before each row; where the first column is no cut's, it decides alone."""
        low, high = (np.searchsorted(self.cuts[0], columns[0], side) for side in ("left", "right"))
        hot = np.flatnonzero(low < high)
        if len(hot):
            n = len(self.cuts[0])
            is_row = np.arange(n + len(hot)) >= n
            order = np.lexsort((is_row, *[np.concatenate([c, x[hot]]) for c, x in zip(self.cuts[::-1], columns[::-1], strict=True)]))
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(~is_row[order])
            high[hot] = before[n:]
        return high.astype(np.int32)


Columns = dict[str, np.ndarray]
#: Rows a sorted stream is compared in.
CHUNK = 1 << 16


def neighbour_links(rows: DataFrame, order: list[str], group: list[str], kernel: Callable[[Columns], tuple[np.ndarray, np.ndarray]], reach: int, parts: int = 0, rest: Callable[[Columns], np.ndarray] | None = None) -> tuple[DataFrame, DataFrame]:
    """u, v, w: pairs that ``kernel`` finds among rows (long columns, no nulls) in the order of ``order``, and how often each was found.

    The kernel gets stretches of the sorted rows and gives node pairs (u, v) of rows at most
    ``reach`` places apart.  Rows are dealt by ranges of the whole order, so one
    hot group spreads over as many tasks as its rows need; the ends of each range, 2 * reach
    rows a task, meet in a step of their own.  ``group``: columns the kernel's pairs agree in.
    With ``parts``, a column ``part`` holds each row's range already (see ``Ranges``), so that
    no pass over the rows is spent on finding ranges.

    Second come the rows, some of them twice, that ``rest`` finds to have partners beyond the kernel's
    reach; it looks at no more than ``reach`` places either way.  ``rest_links`` takes them.
    """
    names = [c for c in rows.columns if c != "part"]
    end_type = pa.struct([(c, pa.int64()) for c in names])

    def links(cols: Columns) -> pa.RecordBatch:
        u, v = kernel(cols)
        u, v = np.minimum(u, v), np.maximum(u, v)
        u, v = u[u != v], v[u != v]
        if len(u):
            sort = np.lexsort((v, u))
            u, v = u[sort], v[sort]
            new = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])]))
            u, v, w = u[new], v[new], np.diff(np.append(new, len(u)))
        else:
            w = u
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(w.astype(np.int64)), pa.nulls(len(u), end_type)], names=["u", "v", "w", "end"])

    def run(batches: Iterator[pa.RecordBatch], edges: bool = True) -> Iterator[pa.RecordBatch]:
        held, context, first = [], 0, True
        tail: Columns | None = None

        def end_rows(cols: Columns, part: slice | np.ndarray, w: int | None = None) -> pa.RecordBatch:
            some = pa.StructArray.from_arrays([pa.array(cols[c][part]) for c in names], fields=list(end_type))
            none = pa.nulls(len(some), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none if w is None else pa.array(np.full(len(some), w)), some], names=["u", "v", "w", "end"])

        def found_in(cols: Columns) -> Iterator[pa.RecordBatch]:
            yield links(cols)
            if rest is not None:
                yield end_rows(cols, rest(cols), 0)

        def taken() -> Columns:
            return {c: np.concatenate([b[c] for b in held]) for c in names}

        for b in batches:
            held.append({c: b.column(c).to_numpy(zero_copy_only=False) for c in names})
            if sum(len(h[names[0]]) for h in held) - context < CHUNK:
                continue
            cols = taken()
            n = len(cols[names[0]])
            if first and edges:
                yield end_rows(cols, slice(0, reach))
            first = False
            yield from found_in(cols)
            change = np.flatnonzero(np.logical_or.reduce([cols[c][1:] != cols[c][:-1] for c in group]))
            keep = min(n - 1 - int(change[-1]) if len(change) else n, CHUNK // 4)  # the last group may go on
            keep = min(n, max(keep, reach))
            held, context = [{c: cols[c][n - keep :] for c in names}], keep
        if held:
            cols = taken()
            n = len(cols[names[0]])
            if not n:
                return
            if first and edges:
                yield end_rows(cols, slice(0, reach))
            if edges:
                yield end_rows(cols, slice(max(0, n - reach), n))
            if first or n > context:
                yield from found_in(cols)

    schema = f"u long, v long, w long, end struct<{', '.join(f'{c}: long' for c in names)}>"
    ranged = rows.repartitionById(parts, F.col("part")).drop("part") if parts else rows.repartitionByRange(*order)
    found = settle(ranged.sortWithinPartitions(*order).mapInArrow(tidy(run), schema))
    ends = found.where("u is null and w is null").select("end.*").distinct().coalesce(1).sortWithinPartitions(*order)
    both = found.unionByName(settle(ends.mapInArrow(tidy(lambda b: run(b, False)), schema)))
    return both.where("u is not null").groupBy("u", "v").agg(F.sum("w").alias("w")), both.where("u is null and w = 0").select("end.*")


#: Rows and bytes of a group that one task compares with each other; a larger group is dealt by pairs of such parts.
PART, PART_BYTES = 1 << 9, 1 << 24
#: Pairs that are looked at together.
PAIRS = 1 << 18
#: Bytes of payloads that a task gathers before it looks at them.
HELD = 1 << 23
#: For the payloads of a task: which pairs of two arrays of places may be the same, and whether two places are.
Judge = Callable[[list[bytes]], tuple[Callable[[np.ndarray, np.ndarray], np.ndarray], Callable[[int, int], bool]]]


def stretches(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[Columns]:
    """Rows sorted by ``by``, in stretches of whole groups."""
    held: list[Columns] = []
    rows = size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append({c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names})
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows < CHUNK and size < HELD:
            continue
        c = {x: np.concatenate([h[x] for h in held]) for x in held[0]}
        change = np.flatnonzero(np.logical_or.reduce([c[x][1:] != c[x][:-1] for x in by]))
        if not len(change):
            held = [c]
            continue
        cut = int(change[-1]) + 1  # the last group may go on
        yield {x: y[:cut] for x, y in c.items()}
        held = [{x: y[cut:] for x, y in c.items()}]
        rows, size = rows - cut, size * (rows - cut) // rows
    if held:
        yield {x: np.concatenate([h[x] for h in held]) for x in held[0]}


def rest_links(rows: DataFrame | Iterable[DataFrame], group: list[str], order: list[str], payloads: Callable[[DataFrame], DataFrame], judge: Judge, weight: Column, fits: Callable[[Columns, np.ndarray, np.ndarray], np.ndarray], within: Callable[[Columns, np.ndarray, np.ndarray], np.ndarray] | None = None, crowd: int = 0, here: Callable[[Columns], Callable[[np.ndarray, np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """u, v: links that join what all pairs of nodes of different labels join that stand in one group, ``fits`` and ``judge`` finds the same.

    rows: no nulls; long columns node, label, those of ``group`` and ``order``, and what ``fits`` and ``here`` read.  Groups of
    one label, or of up to ``crowd`` rows, are left out: nothing in them is open.  In the order of ``order``,
    a row's partners end at the first row that is not ``within`` its reach.  A group of over PART rows, or PART_BYTES
    of ``weight``, is dealt by pairs of parts, so no group is one task; repeated rows do no harm.
    ``here`` tells of a stretch of rows which pairs belong to their group, so that a pair that shares several is judged in one.
    Of several tables of rows, no group in two of them, one after the other is gone through; the payloads come once for all.

    Pairs are made and judged inside a task and never become rows: first only the rows leave it that have a partner, then
    these come back with their payloads (``payloads`` gives id, payload of a table's nodes), and a link leaves only if it joins two labels that the task's links had
    not joined yet, so at most one fewer than a group has rows.
    """
    by = [*group, "low", "high"]

    def dealt(rows: DataFrame) -> DataFrame:
        mixed = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(weight).alias("w"), F.min("label").alias("a"), F.max("label").alias("b")).where((F.col("n") > crowd) & (F.col("a") < F.col("b")))
        out = rows.join(mixed.select(*group, F.greatest(F.ceil(F.col("n") / PART), F.ceil(F.col("w") / PART_BYTES)).alias("s")), group).withColumn("own", F.pmod(F.xxhash64("node"), "s"))
        out = out.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
        return out.select(*rows.columns, "own", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"))

    def met(c: Columns) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of all open pairs, some PAIRS at a time."""
        of = np.concatenate([[0], np.cumsum(np.logical_or.reduce([c[x][1:] != c[x][:-1] for x in by]))])
        same_part = c["low"] == c["high"]
        owned = here(c) if here is not None else None
        held, size, at, k = [], 0, np.arange(len(of)), 0

        def gathered() -> tuple[np.ndarray, np.ndarray]:
            i, j = np.concatenate(held, axis=1)
            if owned is None:
                return i, j
            own = owned(i, j)
            return i[own], j[own]

        while len(at):
            k += 1
            at = at[at + k < len(of)]
            at = at[of[at] == of[at + k]]
            if within is not None:
                at = at[within(c, at, at + k)]
            i = at[(c["label"][at] != c["label"][at + k]) & (same_part[at] | (c["own"][at] != c["own"][at + k]))]
            i = i[fits(c, i, i + k)]
            if len(i):
                held.append(np.stack([i, i + k]))
                size += len(i)
            if size > PAIRS:
                yield gathered()
                held, size = [], 0
        if held:
            yield gathered()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in stretches(batches, by):
            has = np.zeros(len(c["node"]), bool)
            for i, j in met(c):
                has[i] = has[j] = True
            if has.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[x][has]) for x in c], names=list(c))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in stretches(batches, by):
            nodes, first, of = np.unique(c["node"], return_index=True, return_inverse=True)
            may, same = judge([c["payload"][k] for k in first.tolist()])
            root = np.unique(c["label"][first], return_inverse=True)[1]  # of each node
            u, v = [], []
            for i, j in met(c):
                i, j = of[i], of[j]
                pairs = np.unique((np.minimum(i, j) * len(nodes) + np.maximum(i, j))[root[i] != root[j]])  # in several groups, once
                i, j = pairs // len(nodes), pairs % len(nodes)
                some = np.flatnonzero(may(i, j)) if len(pairs) else pairs
                for x, y in zip(i[some].tolist(), j[some].tolist(), strict=True):
                    if root[x] != root[y] and same(x, y):
                        root[root == root[y]] = root[x]
                        u.append(x)
                        v.append(y)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(nodes[u]), pa.array(nodes[v])], names=["u", "v"])

    def open_rows(rows: DataFrame) -> DataFrame:
        rows = dealt(rows)
        kinds = ", ".join(f"{x} {kind}" for x, kind in rows.dtypes)
        return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(tidy(opened), kinds)

    some = [settle(open_rows(x)) for x in ([rows] if isinstance(rows, DataFrame) else rows)]
    held = payloads(functools.reduce(DataFrame.unionByName, [x.select("node") for x in some]).distinct())
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: few bytes are much work here

    def links(x: DataFrame) -> DataFrame:
        full = x.join(held, F.col("node") == F.col("id")).select(*x.columns, "payload")
        return full.repartition(parts, *by).sortWithinPartitions(*by, *order).mapInArrow(tidy(joined), "u long, v long").distinct()

    return links(some[0]) if len(some) == 1 else functools.reduce(DataFrame.unionByName, [settle(links(x)) for x in some]).distinct()


def ends_of(links: DataFrame, name: str) -> DataFrame:
    """The nodes of links (u, v), once each."""
    return links.select(F.col("u").alias(name)).unionByName(links.select(F.col("v").alias(name))).distinct()


def completed(known: DataFrame, found: DataFrame) -> DataFrame:
    """``known`` (node, label) with what the links ``found`` (u, v) join."""
    found = settle(found)
    if found.isEmpty():
        return known
    return components(known.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(found))


def confirmed(links: DataFrame, payloads: DataFrame, same: Callable[[bytes, bytes], bool]) -> DataFrame:
    """node, label of the components of the links (u, v, w) whose payloads (id, payload) are ``same``.

    Work is per link, never per pair of a group: first each node's likeliest
    link (largest w), then of the others those whose ends are still apart.
    """
    both = links.select(F.col("u").alias("x"), F.col("v").alias("y"), "w").unionByName(links.select(F.col("v").alias("x"), F.col("u").alias("y"), "w"))
    best = both.groupBy("x").agg(F.max(F.struct("w", "y")).alias("b")).select(F.least("x", "b.y").alias("u"), F.greatest("x", "b.y").alias("v")).distinct()
    best = settle(best)
    first = settle(verified(best, payloads, same))
    known = components(first)
    named = links.select("u", "v").join(best, ["u", "v"], "left_anti")
    for c in "uv":
        named = named.join(known.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c, "left")
    apart = settle(named.where(F.coalesce("lu", "u") != F.coalesce("lv", "v")).select("u", "v"))
    second = settle(verified(apart, payloads, same))
    if second.isEmpty():
        return known
    return components(first.unionByName(second))


def verified(links: DataFrame, payloads: DataFrame, same: Callable[[bytes, bytes], bool]) -> DataFrame:
    """The links (u, v) whose payloads are ``same``; a payload is shipped once for its node and once for each smaller partner."""
    rows = links.join(payloads.select(F.col("id").alias("v"), F.col("payload").alias("b")), "v").join(payloads.select(F.col("id").alias("u"), F.col("payload").alias("a")), "u").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            alike = [same(x.as_py(), y.as_py()) for x, y in zip(b.column("a"), b.column("b"), strict=True)]
            if any(alike):
                yield b.select(["u", "v"]).filter(pa.array(alike))

    return rows.mapInArrow(tidy(run), "u long, v long")
