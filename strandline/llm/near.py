"""3. MinHash near-dedup with an LSH forest.

A document's set holds its distinct 5-word shingles.  Documents of equal sets
are one class from the start.  Each class has a signature of TREES sorted
orders of DEPTH minimum hashes.  In every order, classes that share enough
leading values form a region; a region of more than CROWD classes is deepened
value by value until it is small.  Candidates are all pairs of a small region
and, everywhere, the NEIGHBOURS next with the longest common prefixes.  The
orders are dealt by ranges, so a crowded region is no task of its own.  One
bit of each minimum hash travels along and sets aside pairs that agree far
too rarely; every other candidate is confirmed on the full sets, link by link.
Then each region that was crowded at its least depth is gone through whole:
all its pairs that these links left in different components are candidates,
too, dealt by parts of the region.  They are confirmed where the region's sets lie
together, and only links that join something leave it.  Components of confirmed links are the
near-duplicate groups.

A region's least depth follows from the threshold: a pair there shares no
region with probability under 2 in 100,000 (4 values at 0.85, 3 at 0.8),
crowded or not.  The agreement test lies six standard deviations below the
threshold.

Words are hashed modulo a prime, shingles and sets are compared by 64-bit
hashes; the class of a set is the BLAKE2b digest of its sorted hashes.

Edge cases.  Null and empty texts: empty set, linked with nothing, kept.
Fewer than 5 words: the whole sequence is one shingle.  Null ids are members;
a group's component is its smallest id that is not null, or null.  Repeated
rows and ties: one class.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import flat, join_keyed, keyed, pieces, settle, tidy
from ._grouping import Columns, Judge, completed, confirmed, ends_of, neighbour_links, rest_links
from ._rolling import Exact, digests, lowered, mix, seeds, words

SHINGLE, PERCENT = 5, 80
TREES, DEPTH, CROWD, NEIGHBOURS = 16, 8, 8, 2
MISS = 2e-5
SLICE, ROWS = 1 << 19, 1 << 10
_FACTORS = seeds(TREES * DEPTH, 7) | np.uint64(1)


def least_depth(percent: int) -> int:
    """The most leading values that a pair at the threshold shares in some order but for a share MISS of pairs."""
    return max([d for d in range(2, DEPTH + 1) if (1 - (percent / 100) ** d) ** TREES <= MISS], default=2)


def least_agreement(percent: int) -> int:
    """Of the signature's TREES * DEPTH bits, how many agree at least in a pair at the threshold."""
    n, p = TREES * DEPTH, 0.5 + percent / 200
    return int(n * p - 6 * (n * p * (1 - p)) ** 0.5)


def shingles(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and their offsets."""
    _, _, h, at = words(lowered(data), off)
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), count)
    start = np.repeat(at[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    end = start + np.minimum(k, n[row])
    x = mix(Exact(h).of(start, end) + (end - start).astype(np.uint64))
    order = np.argsort(x)
    order = order[np.argsort(row[order].astype(np.int16 if len(n) <= ROWS else np.int64), kind="stable")]  # a radix sort
    x, row = x[order], row[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (row[1:] != row[:-1])]) if len(x) else np.zeros(0, bool)
    return x[new], np.searchsorted(row[new], np.arange(len(n) + 1))


def slices(off: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, z in pieces(off, SLICE):
        for i in range(a, z, ROWS):
            yield i, min(z, i + ROWS)


def signatures(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, th, n (set size), cid (digest of the set), sig (array of longs: TREES orders of DEPTH values of 16 bits, then a bit of each value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            for a, z in slices(off):
                x, at = shingles(data[off[a] : off[z]], off[a : z + 1] - off[a], k)
                n = np.diff(at)
                some = np.flatnonzero(n)
                sig = np.zeros((z - a, TREES * DEPTH), np.uint16)
                cid = np.zeros(z - a, np.int64)
                if len(some):
                    first = at[some]
                    y = mix(x)
                    cid[some] = digests(x.astype("<u8").view(np.uint8), 8 * first, 8 * at[some + 1])
                    for j, f in enumerate(_FACTORS):
                        sig[some, j] = (mix(np.minimum.reduceat(y * f, first)) & np.uint64(0xFFFF)).astype(np.uint16)
                values = sig.astype(">u2").view(">i8").astype(np.int64)  # of equal beginnings the longs lie together
                packed = np.concatenate([values, np.packbits(sig & 1, axis=1).view(np.int64)], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, packed.size + 1, packed.shape[1], dtype=np.int32)), pa.array(packed.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(a, z - a), b.column("th").slice(a, z - a), pa.array(n.astype(np.int64)), pa.array(cid), lists], names=["doc_id", "th", "n", "cid", "sig"])

    return keyed(docs).mapInArrow(tidy(run), "doc_id long, th long, n long, cid long, sig array<long>")


def forest_pairs(percent: int, least: int):
    """The kernel for sorted rows (t, head, rest, cid, n, b0, b1): a tree's number, its eight values in two longs, set size, bits."""
    agree = least_agreement(percent)

    def common(x: np.ndarray) -> np.ndarray:
        """Leading 16-bit values that are zero."""
        x = x.view(np.uint64)
        return sum((x >> np.uint64(16 * k) == 0).astype(np.int8) for k in range(4))

    def kernel(c: Columns) -> tuple[np.ndarray, np.ndarray]:
        m = len(c["t"])
        if m < 2:
            return c["cid"][:0], c["cid"][:0]
        head, rest = common(c["head"][1:] ^ c["head"][:-1]), common(c["rest"][1:] ^ c["rest"][:-1])
        lcp = np.where(c["t"][1:] == c["t"][:-1], np.where(head == 4, 4 + rest, head), 0).astype(np.int8)
        before = np.concatenate([[0], lcp])  # with the row before
        depth = np.full(m, DEPTH + 1, np.int8)
        for d in range(least, DEPTH + 1):
            region = np.cumsum(before < d)
            size = np.bincount(region)[region]
            depth[(depth > DEPTH) & (size <= CROWD)] = d
        depth = np.minimum(depth, DEPTH)
        u, v, shared = [], [], np.full(m, DEPTH, np.int8)
        for k in range(1, CROWD):
            shared = np.minimum(shared[: m - k], before[k:])
            if not len(shared):
                break
            at = np.flatnonzero((shared >= least) & ((shared >= depth[: m - k]) | (k <= NEIGHBOURS)))
            n = np.stack([c["n"][at], c["n"][at + k]])
            at = at[100 * n.min(axis=0) >= percent * n.max(axis=0)]
            same = 128 - sum(np.bitwise_count(c[b][at].view(np.uint64) ^ c[b][at + k].view(np.uint64)).astype(np.int64) for b in ("b0", "b1"))
            at = at[same >= agree]
            u.append(c["cid"][at])
            v.append(c["cid"][at + k])
        return np.concatenate(u), np.concatenate(v)

    return kernel


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """u, v, w: classes (cid, n, sig) that are neighbours in w orders and may be similar enough."""
    lanes, at = DEPTH // 4, TREES * (DEPTH // 4)
    trees = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.col("sig")[t * lanes].alias("head"), F.col("sig")[t * lanes + 1].alias("rest")) for t in range(TREES)])
    rows = classes.select(F.explode(trees).alias("x"), "cid", "n", F.col("sig")[at].alias("b0"), F.col("sig")[at + 1].alias("b1")).select("x.*", "cid", "n", "b0", "b1")
    return neighbour_links(rows, ["t", "head", "rest", "cid"], ["t", "head"], forest_pairs(percent, least_depth(percent)), CROWD - 1)[0]


def crowded(classes: DataFrame, comp: DataFrame, percent: int, members: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """u, v: links that join what all similar pairs of classes (cid, n, sig) join that share a region at its least depth of more than CROWD classes and that ``comp`` (node, label) keeps apart."""
    least, agree, at = least_depth(percent), least_agreement(percent), TREES * (DEPTH // 4)

    def head(t: int):
        lanes = [F.col("sig")[t * (DEPTH // 4) + i] for i in range(DEPTH // 4)]
        whole, part = divmod(least, 4)
        shown = lanes[:whole] + ([F.shiftrightunsigned(lanes[whole], 64 - 16 * part)] if part else [])
        return F.struct(F.lit(t).cast("long").alias("t"), *[x.alias(f"h{i}") for i, x in enumerate(shown)])

    rows = classes.join(comp, F.col("cid") == F.col("node"), "left").select(F.explode(F.array(*[head(t) for t in range(TREES)])).alias("x"), F.col("cid").alias("node"), F.coalesce("label", "cid").alias("label"), "n", F.col("sig")[at].alias("b0"), F.col("sig")[at + 1].alias("b1"))
    rows = rows.select("x.*", "node", "label", "n", "b0", "b1")

    def fits(c: Columns, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        enough = 100 * np.minimum(c["n"][i], c["n"][j]) >= percent * np.maximum(c["n"][i], c["n"][j])
        return enough & (128 - sum(np.bitwise_count((c[b][i] ^ c[b][j]).view(np.uint64)).astype(np.int64) for b in ("b0", "b1")) >= agree)

    def within(c: Columns, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return 100 * c["n"][i] >= percent * c["n"][j]

    return rest_links(rows, [c for c in rows.columns if c == "t" or c[0] == "h"], ["n", "node"], members, judged(percent), 8 * F.col("n"), fits, within, CROWD)


def judged(percent: int) -> Judge:
    """For sets (payloads as of ``similar``): which pairs reach the similarity, told by whole sets at once."""

    def judge(payloads: list[bytes]):
        n = np.array([len(p) // 8 for p in payloads])
        at = np.cumsum(n) - n
        code = np.unique(np.frombuffer(b"".join(payloads), "<u8"), return_inverse=True)[1]
        mark = np.zeros(len(code), np.uint8)

        def reach(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.zeros(len(i), bool)
            order = np.argsort(i, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
                x, many = i[own[0]], j[own]
                held = code[at[x] : at[x] + n[x]]
                mark[held] = 1
                ends = np.cumsum(n[many])
                both = np.add.reduceat(mark[code[np.arange(ends[-1]) + np.repeat(at[many] - ends + n[many], n[many])]], ends - n[many], dtype=np.int64)
                mark[held] = 0
                out[own] = 100 * both >= percent * (n[x] + n[many] - both)
            return out

        return reach, lambda x, y: True

    return judge


def similar(percent: int):
    """Whether two sets, given as sorted distinct 64-bit hashes, reach the similarity."""

    def same(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        total = len(x) + len(y)
        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return False
        z = np.sort(np.concatenate([x, y]))
        both = int((z[1:] == z[:-1]).sum())
        return 100 * both >= percent * (total - both)

    return same


def groups(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """doc_id, th, n_shingles, component_id and component_th (smallest (id, text hash) of the group) of every row."""
    sets = settle(signatures(docs, k))
    classes = settle(sets.where("n > 0").groupBy("cid", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("rep"), F.first("sig").alias("sig")))
    links = settle(candidates(classes.select("cid", "n", "sig"), percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            for a, z in slices(off):
                x, at = shingles(data[off[a] : off[z]], off[a : z + 1] - off[a], k)
                blobs = [x[at[i] : at[i + 1]].astype("<u8").tobytes() for i in range(z - a)]
                yield pa.RecordBatch.from_arrays([b.column("cid").slice(a, z - a), pa.array(blobs, pa.binary())], names=["id", "payload"])

    def members(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, F.col("cid") == F.col("node")).select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th"), "cid")
        # one row a class: rows that repeat id and text give the same set
        return settle(join_keyed(keyed(docs), wanted).dropDuplicates(["cid"]).select("text", "cid").mapInArrow(tidy(run), "id long, payload binary"))

    comp = confirmed(links, members(ends_of(links, "node")), similar(percent))
    comp = completed(comp, crowded(classes.select("cid", "n", "sig"), comp, percent, members))
    named = classes.select("cid", "n", "rep").join(comp, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("rep").alias("least"))
    by_class = named.join(least, "label").select("cid", "n", F.col("least.doc_id").alias("component_id"), F.col("least.th").alias("component_th"))
    out = sets.select("doc_id", "th", "n", "cid").join(by_class, ["cid", "n"], "left")
    empty = F.col("n") == 0
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(empty, F.col("th")).otherwise(F.col("component_th")).alias("component_th"))


def near_unique(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id.  Documents without words all stay."""
    found = groups(docs, percent, k)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("component_th")))
    stay = stay.groupBy("doc_id", "th").agg(F.count("*").alias("_n"), F.max("n_shingles").alias("_w"))
    names = docs.columns
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    rows = join_keyed(rows, stay)
    alone = rows.where("_n = 1 or _w = 0").select("_row.*")
    # of rows that repeat id and text, the first in the order of all their columns
    again = rows.where("_n > 1 and _w > 0").groupBy("doc_id", "th").agg(F.min(F.to_json("_row")).alias("_j"), F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
    return alone.unionByName(again)


def op3(docs: DataFrame) -> DataFrame:
    out = groups(docs, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
