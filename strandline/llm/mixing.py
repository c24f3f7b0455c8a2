"""2. Mixing sources to target weights by subset-sum budget fitting.

Targets come from weights (see ``targets``).  A source's target is met by
whole passes over its documents and, for the rest, a subset of them: documents
are counted by exact length; a bounded-knapsack dynamic programme over the
lengths' counts finds the largest sum within the budget (of a budget beyond
WINDOW words a proportional share of each length is taken first, and the
programme fits the rest); the documents of a length are then chosen in
seeded hash order.  Choices are made on (id, text hash, size) alone; rows are
fetched once.

Edge cases.  Null text: size 0, never taken more than a pass takes it (adds
nothing).  Null source: a source of its own, last.  Repeated rows: separate
documents, chosen separately.  Empty table: empty result.  A source of size 0
has target 0.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import WORD, settle

WEIGHTS = (5, 2, 1)
TOTAL, MOST, SEED, SALTS = 1.5, 2.0, 20240229, 64
#: The dynamic programme's budget in words is held under this, or this many of the longest length.
WINDOW, DP_LENGTHS = 1 << 20, 4


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Shares of ``total * sum(sizes)`` by weight; none above most * its size, the excess reshared by weight."""
    budget, out, open_ = total * sum(sizes), [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    while open_ and budget > 0:
        w = sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if budget * weights[i] / w >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = budget * weights[i] / w
            break
        for i in full:
            out[i] = most * sizes[i]
        budget -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their sum comes as near to ``budget`` from below as the programme can."""
    order = [i for i in np.argsort(lengths) if lengths[i] > 0 and counts[i] > 0]
    take = [0] * len(lengths)
    whole = sum(lengths[i] * counts[i] for i in order)
    if budget >= whole:
        for i in order:
            take[i] = counts[i]
        return take
    bound = max(WINDOW, DP_LENGTHS * max((lengths[i] for i in order), default=0))
    for i in order:
        take[i] = counts[i] * max(0, budget - bound) // whole  # so the programme gets room to choose in
    rest = budget - sum(take[i] * lengths[i] for i in order)
    for i in reversed(order):
        if rest <= bound:
            break
        more = min(counts[i] - take[i], (rest - bound) // lengths[i] + 1, rest // lengths[i])
        take[i] += more
        rest -= more * lengths[i]
    reached, mask, items = 1, (1 << (rest + 1)) - 1, []
    came = np.full(rest + 1, -1, np.int32)  # the item by which a sum was first reached
    for i in order:
        left, part = min(counts[i] - take[i], rest // lengths[i]), 1
        while left > 0 and not reached >> rest & 1:
            part_n = min(part, left)
            new = (reached << part_n * lengths[i]) & mask & ~reached
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(rest // 8 + 1, "little"), np.uint8), bitorder="little")[: rest + 1]
                came[bits.astype(bool)] = len(items)
                reached |= new
            items.append((i, part_n))
            left -= part_n
            part *= 2
    at = reached.bit_length() - 1
    while at > 0:
        i, n = items[came[at]]
        take[i] += n
        at -= n * lengths[i]
    return take


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, th (text hash), source, size (words of the text; null: 0)."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def mix(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST, seed: int = SEED) -> DataFrame:
    """sizes (doc_id, th, source, size) with source_size, target, copies.

    Weights repeat over the sources in code-point order, null last.  The driver
    sees one row a source: their number, not that of the documents, bounds it.
    """
    spark = sizes.sparkSession
    hist = settle(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    per = [(r.source, int(r.total)) for r in hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total")).collect()]
    per.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    goal = targets([s for _, s in per], [weights[i % len(weights)] for i in range(len(per))], total, most)
    plan = spark.createDataFrame([(s, n, float(t)) for (s, n), t in zip(per, goal, strict=True)], "source string, source_size long, target double")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = int(target // size) if size else 0
        rest = int(round(target - passes * size))
        take = fit(pdf["size"].tolist(), pdf["n"].tolist(), rest) if size else [0] * len(pdf)
        return pdf.assign(passes=passes, extra=take)[["source", "size", "n", "source_size", "target", "passes", "extra"]]

    quota = settle(hist.join(plan, hist.source.eqNullSafe(plan.source)).drop(plan.source).groupBy("source").applyInPandas(fitted, "source string, size long, n long, source_size long, target double, passes int, extra long"))
    # Seeded choice inside a length: ranks by salt, so that no window holds a whole source or length.
    rank = F.xxhash64(F.lit(seed), "doc_id", "th", "source", "size")
    ranked = sizes.withColumn("_h", rank).withColumn("_salt", F.pmod(F.shiftright("_h", 8), F.lit(SALTS)).cast("int"))
    counts = ranked.groupBy("source", "size", "_salt").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("source", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    q, b = quota.alias("q"), before.alias("b")
    cut = q.join(b, F.col("q.source").eqNullSafe(F.col("b.source")) & (F.col("q.size") == F.col("b.size"))).select(
        F.col("b.source").alias("_s"), F.col("b.size").alias("_z"), F.col("b._salt").alias("_t"), "source_size", "target", "passes", F.least(F.greatest(F.col("extra") - F.col("_before"), F.lit(0)), F.col("_n")).alias("_take"))
    r = ranked.join(cut, ranked.source.eqNullSafe(cut._s) & (ranked.size == cut._z) & (ranked._salt == cut._t))
    r = r.withColumn("_r", F.row_number().over(Window.partitionBy("source", "size", "_salt").orderBy("_h", "doc_id", "th")))
    return r.withColumn("copies", F.col("passes") + F.when(F.col("_r") <= F.col("_take"), 1).otherwise(0)).drop("_h", "_salt", "_s", "_z", "_t", "_take", "_r", "passes")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, its columns unchanged.

    Rows that repeat id, text and source share their copies out in the order of their columns.
    """
    names = docs.columns
    # a source's documents of a length are taken _low times or once more
    per = mix(sized(docs), **how).groupBy("doc_id", "th", "source").agg(F.count("*").alias("_n"), F.min("copies").alias("_low"), F.sum("copies").alias("_all"))
    taken = settle(per.withColumn("_more", F.col("_all") - F.col("_n") * F.col("_low")).where("_all > 0"))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col("source").cast("string").alias("source"), row.alias("_row"))
    t = taken.withColumnsRenamed({"doc_id": "_id", "th": "_th", "source": "_source"})
    rows = rows.join(t, rows.doc_id.eqNullSafe(t._id) & (rows.th == t._th) & rows.source.eqNullSafe(t._source))
    alone = rows.where("_n = 1").select("_row", F.col("_all").alias("_times"))
    order = F.row_number().over(Window.partitionBy("doc_id", "th", "source").orderBy(F.to_json("_row")))
    again = rows.where("_n > 1").withColumn("_i", order).select("_row", (F.col("_low") + (F.col("_i") <= F.col("_more")).cast("int")).alias("_times"))
    out = alone.unionByName(again).where("_times > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).select("_row.*")


def op2(docs: DataFrame) -> DataFrame:
    return mix(sized(docs)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


