"""6. Nearest neighbours by inner product: a block matrix join on int8 tiles.

Vectors are quantised once, to int8 with a scale of their own, and packed into
blocks of codes, scales and norms; each query block meets each candidate block once.  A
tile product of the codes (float32 over at most EXACT dimensions at a time,
so every sum is a whole number below 2**24) gives every inner product up to a proven
error.  Of each tile go on, a query, the candidates whose upper bound
reaches its k-th best lower bound there; a heap over all tiles finds the k-th best
lower bound of all, and the few that reach it are fetched and computed again in double precision from
the original vectors, component after component, so equal vectors score
exactly alike.  Nothing is approximate in the result.

Edge cases.  Null, zero or non-finite vectors, and vectors of another length
than the query's, take no part.  A null id takes no part.  Rows that repeat an
id are candidates each; a query is every row whose id is one, answered once
per distinct vector, its own id excluded.  Fewer than k candidates: all.
Empty table: empty result.
Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import tidy

#: Rows a block: with 64 dimensions a block is a quarter of a MB of codes.
CANDIDATES, QUERIES = 4096, 1024
#: Products of int8 codes that float32 adds up exactly: 127 * 127 * EXACT < 2**24.
EXACT = 1024
BLOCK_SCHEMA = "block int, part long, ids binary, hashes binary, codes binary, scales binary, rests binary, norms binary, dim int"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (array<double>), h (its hash) of the rows that can take part."""
    v = F.col(vector).cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.exists("v", lambda x: x != 0) & finite).withColumn("h", F.xxhash64("v"))


def packed(rows: DataFrame, blocks: int, size: int) -> DataFrame:
    """Rows dealt to ``blocks`` by hash; one row per block, dimension and at most ``size`` vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def out(key: tuple[int, int]) -> pa.RecordBatch:
            got = held.pop(key)
            ids, hashes = (np.array([g[k] for g in got], "<i8") for k in (0, 1))
            blobs = {n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("ids", "hashes", "codes", "scales", "rests", "norms"), (ids, hashes, *quantised(np.stack([v for _, _, v in got]))), strict=True)}
            return pa.RecordBatch.from_pydict({"block": pa.array([key[0]], pa.int32()), "part": pa.array([int(hashes[0])], pa.int64()), **blobs, "dim": pa.array([key[1]], pa.int32())})

        for b in batches:
            offs = b.column("v").offsets.to_numpy()
            vals = b.column("v").values.to_numpy(zero_copy_only=False)
            for blk, i, h, s, e in zip(*[b.column(c).to_pylist() for c in ("block", "id", "h")], offs[:-1], offs[1:], strict=True):
                key = (blk, int(e - s))
                held.setdefault(key, []).append((i, h, vals[s:e].copy()))
                if len(held[key]) >= size:
                    yield out(key)
        for key in sorted(held):
            yield out(key)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    return dealt.select("block", "id", "h", "v").mapInArrow(tidy(pack), BLOCK_SCHEMA)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, the residuals' norms, and the vectors' norms."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    rest = x - codes * scale[:, None]
    return codes, scale, np.sqrt((rest * rest).sum(axis=1)), np.sqrt((x * x).sum(axis=1))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of int8 codes, exact."""
    out = np.zeros((len(q), len(c)))
    for d in range(0, q.shape[1], EXACT):
        out += q[:, d : d + EXACT].astype(np.float32) @ c[:, d : d + EXACT].astype(np.float32).T
    return out


def tile(q: dict[str, np.ndarray], c: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, candidate rows, lower and upper bounds of what may be among a query's k best of this tile."""
    approx = products(q["codes"], c["codes"]) * q["scales"][:, None] * c["scales"][None, :]
    # <q,c> - approx = <q_rest, c> + <q_code, c_rest>: Cauchy-Schwarz on both, and room for rounding
    err = q["rests"][:, None] * c["norms"][None, :] + (q["norms"] + q["rests"])[:, None] * c["rests"][None, :]
    err = err * (1 + 1e-9) + (1e-12 + 1e-15 * q["codes"].shape[1]) * q["norms"][:, None] * c["norms"][None, :]
    own = q["ids"][:, None] == c["ids"][None, :]
    low = np.where(own, -np.inf, approx - err)
    kk = min(k, low.shape[1])
    bar = -np.partition(-low, kk - 1, axis=1)[:, kk - 1]
    r, s = np.nonzero((approx + err >= bar[:, None]) & ~own)
    keep = first_of_equal(r, c["hashes"][s], low[r, s], c["ids"][s], k)
    r, s = r[keep], s[keep]
    return r, s, low[r, s], (approx + err)[r, s]


def first_of_equal(query: np.ndarray, h: np.ndarray, low: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest ids among a query's candidates of one vector (equal hash and bound), in query order: equal vectors tie, so no other of them can be among the k best."""
    order = np.lexsort((ids, low, h, query))
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (query[a] != query[b]) | (h[a] != h[b]) | (low[a] != low[b])
    at = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(at, np.diff(np.append(at, len(order))))
    return order[rank < k]


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row for which ``is_query(id column)`` holds."""
    rows = usable(vectors, id_col, vector)
    queries = rows.where(is_query(F.col("id"))).distinct()
    n, m = rows.count(), queries.count()
    nc, nq = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    fields = ("ids", "hashes", "codes", "scales", "rests", "norms")
    cand = packed(rows, nc, CANDIDATES).select(F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"), *[F.col(f).alias(f"c_{f}") for f in fields], "dim")
    quer = packed(queries, nq, QUERIES).select(F.col("block").alias("qb"), *[F.col(f).alias(f"q_{f}") for f in fields], "dim")
    pairs = quer.hint("shuffle_hash").join(cand, ["qb", "dim"]).repartition(max(1, min(nc * nq, 4096)), F.col("qb"), F.xxhash64("c_ids"))

    def side(row: dict, of: str) -> dict[str, np.ndarray]:
        types = {"ids": "<i8", "hashes": "<i8", "codes": np.int8}
        out = {f: np.frombuffer(row[f"{of}_{f}"], types.get(f, "<f8")) for f in fields}
        out["codes"] = out["codes"].reshape(-1, row["dim"])
        return out

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                q, c = side(row, "q"), side(row, "c")
                r, s, low, high = tile(q, c, k)
                at = pa.array(np.searchsorted(r, np.arange(len(q["ids"]) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (c["ids"][s], c["hashes"][s], low, high)]
                yield pa.RecordBatch.from_arrays([pa.array(q["ids"]), pa.array(q["hashes"]), *lists], names=["query_id", "query_h", "ids", "hashes", "lows", "highs"])

    tops = pairs.mapInArrow(tidy(best), "query_id long, query_h long, ids array<long>, hashes array<long>, lows array<double>, highs array<double>")

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        lows: list[float] = []  # a heap of the k best lower bounds
        for run in pdf["lows"]:
            for x in run:
                heapq.heappush(lows, x) if len(lows) < k else heapq.heappushpop(lows, x)
        bar = lows[0] if len(lows) == k else -np.inf
        keep = np.concatenate([np.asarray(x) for x in pdf["highs"]]) >= bar
        ids, hashes = (np.concatenate([np.asarray(x, np.int64) for x in pdf[c]])[keep] for c in ("ids", "hashes"))
        some = first_of_equal(np.zeros(len(ids), np.int64), hashes, np.concatenate([np.asarray(x) for x in pdf["lows"]])[keep], ids, k)
        ids, hashes = ids[some], hashes[some]
        return pd.DataFrame({"query_id": np.full(len(ids), pdf["query_id"].iloc[0]), "query_h": np.full(len(ids), pdf["query_h"].iloc[0]), "id": ids, "h": hashes})

    some = tops.groupBy("query_id", "query_h").applyInPandas(merged, "query_id long, query_h long, id long, h long").distinct()
    q = queries.select(F.col("id").alias("query_id"), F.col("h").alias("query_h"), F.col("v").alias("_q"))
    both = some.join(rows, ["id", "h"]).join(q, ["query_id", "query_h"])
    score = F.aggregate(F.zip_with("_q", "v", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    ranked = both.select("query_id", "query_h", F.col("id").alias("vec_id"), score.alias("score"))
    w = Window.partitionBy("query_id", "query_h").orderBy(F.desc("score"), "vec_id")  # some k rows a query, more only in ties
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, lambda i: i % 20 == 0)
