"""10. Document fingerprints: canonical exact digests, DataFrame functions only.

The canonical form of a text is its NFC normal form, case-folded (upper then
lower, and ß as ss), with every run of white space one blank and none
at the ends.  Its fingerprint is two xxhash64 values with different seeds, 32
hex digits.  Should texts of one hash differ by their SHA-256, their canonical
bytes are compared, and all but the smallest get a suffix that numbers them, so
fingerprints are equal exactly if canonical texts are.  The likeness of two
fingerprints is therefore 1 or 0.

NFC covers composition of base letters with combining marks and single
code-point decompositions, by tables that are generated from the Unicode data
at plan time; conjoining Hangul jamo are left as they are.

Edge cases.  Null text: empty.  Empty text: fingerprint of the empty string.
Null id: ordered first, as its own document.  Repeated rows: documents that
follow each other, ties in id ordered by text hash.  Empty table: empty result.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import settle

#: Ids a bucket: documents of a bucket are ordered in one task, so it bounds a task's rows.
SPAN = 256
_SEEDS = (0x51, 0xA7)


@functools.lru_cache(1)
def _tables() -> tuple[dict[str, str], dict[str, str]]:
    """Pairs (base + mark -> composed), singles (code point -> its one-point NFC form)."""
    pairs, singles = {}, {}
    for i in range(0xC0, 0x2FA1E):
        c = chr(i)
        if 0xAC00 <= i <= 0xD7A3 or 0xD800 <= i <= 0xDFFF:
            continue
        d = unicodedata.decomposition(c)
        if not d or d[0] == "<":
            continue
        nfc = unicodedata.normalize("NFC", c)
        parts = "".join(chr(int(x, 16)) for x in d.split())
        if len(parts) == 2 and nfc == c:
            pairs[parts] = c
        elif len(nfc) == 1 and nfc != c:
            singles[c] = nfc
    return pairs, singles


def _composed(text: Column) -> Column:
    """NFC of texts that hold combining marks: each letter takes in its marks, ordered by combining class."""
    pairs, _ = _tables()
    classes = {c: f"{unicodedata.combining(c):03}" for c in map(chr, range(0x300, 0x1E900)) if unicodedata.combining(c)}
    table, ranks = (F.map_from_arrays(F.split(F.lit(" ".join(d)), " "), F.split(F.lit(" ".join(d.values())), " ")) for d in (pairs, classes))  # folded to literals
    cluster = F.regexp_extract_all(text, F.lit(r"(?s)\P{M}\p{M}*|\p{M}+"), F.lit(0))

    def merged(c: Column) -> Column:
        marks = F.filter(F.split(F.substring(c, 2, 2147483647), ""), lambda m: m != "")
        ordered = F.array_sort(F.transform(marks, lambda m, i: F.struct(F.coalesce(ranks[m], F.lit("000")).alias("r"), i.alias("i"), m.alias("m"))))
        return F.aggregate(ordered, F.substring(c, 1, 1), lambda acc, s: F.coalesce(table[F.concat(acc, s["m"])], F.concat(acc, s["m"])))

    return F.array_join(F.transform(cluster, lambda c: F.when(F.length(c) == 1, c).otherwise(merged(c))), "")


def _ranges(chars: str, gap: int = 64) -> str:
    """A character class that holds all of ``chars``; near ones share a range, so it is short."""
    out: list[list[int]] = []
    for i in sorted(map(ord, chars)):
        if out and i - out[-1][1] <= gap:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out)


def canonical(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    _, singles = _tables()
    keys = "".join(singles)
    one = F.translate(text, keys, "".join(singles.values()))
    odd = r"[\p{M}" + _ranges(keys) + "]"
    nfc = F.when(F.length(text) == F.octet_length(text), text).when(text.rlike(odd), _composed(one)).otherwise(text)
    folded = F.replace(F.lower(F.upper(nfc)), F.lit("ß"), F.lit("ss"))  # the one folding that lengthens
    return F.trim(F.regexp_replace(folded, r"[\s\p{Z}\x{85}]+", " "))


def wide(canon: Column) -> Column:
    """128 bits of xxhash64 as 32 hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(s), canon, F.length(canon))), 16, "0") for s in _SEEDS]))


def clashes(rows: DataFrame) -> DataFrame:
    """(fingerprint, canon, tail) for canonical texts that share a hash with a smaller one.

    Hashes with more than one SHA-256 are sought first, so only their texts travel;
    these are compared byte by byte, copies merged before the shuffle.
    """
    digest = F.sha2(F.col("canon").cast("binary"), 256)
    shared = settle(rows.select("fingerprint", digest.alias("_d")).groupBy("fingerprint").agg(F.min("_d").alias("_a"), F.max("_d").alias("_z")).where("_a <> _z").select("fingerprint"))
    if shared.isEmpty():
        return shared.select("fingerprint", F.lit("").alias("canon"), F.lit(0).alias("tail"))
    w = Window.partitionBy("fingerprint").orderBy("canon")
    return rows.select("fingerprint", "canon").join(shared, "fingerprint", "left_semi").distinct().withColumn("tail", F.row_number().over(w) - 1).where("tail > 0")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), canon, fingerprint of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), canonical(text).alias("canon")).withColumn("fingerprint", wide(F.col("canon")))
    tails = settle(clashes(rows))
    if tails.isEmpty():  # two texts of one 128-bit hash are all but impossible; then nothing needs a number
        return rows
    numbered = rows.join(tails, ["fingerprint", "canon"], "left")
    return numbered.withColumn("fingerprint", F.when(F.col("tail").isNull(), F.col("fingerprint")).otherwise(F.concat("fingerprint", F.lit("#"), F.col("tail").cast("string")))).select(*rows.columns)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, first (smallest doc_id of the group), copies of every row's group of equal canonical texts."""
    rows = fingerprinted(docs).select("doc_id", "fingerprint")
    return rows.join(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "fingerprint")


def with_next(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, fingerprint) with next_text, next_fingerprint: of the next document in ascending doc_id (after the last: the first).

    Documents are dealt by ranges of SPAN ids; a range's last one takes the first text of
    the next range that has any.  Only the list of ranges of ranges is ordered as a whole.
    """
    base = rows.select("doc_id", "text", "fingerprint", F.coalesce(F.floor(F.col("doc_id") / SPAN), F.lit(-(2**62))).alias("_b"))
    lists = base.select("_b").distinct().withColumn("_g", F.floor(F.col("_b") / SPAN))
    tops = lists.groupBy("_g").agg(F.min("_b").alias("_first"))
    tops = tops.withColumn("_after", F.coalesce(F.lead("_first").over(Window.orderBy("_g")), F.min("_first").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, 0))))
    follow = lists.join(tops, "_g").select("_b", F.coalesce(F.lead("_b").over(Window.partitionBy("_g").orderBy("_b")), F.col("_after")).alias("_nb"))
    w = Window.partitionBy("_b").orderBy("doc_id", "fingerprint")
    seen = base.withColumn("_next", F.lead(F.struct("text", "fingerprint")).over(w)).withColumn("_i", F.row_number().over(w))
    opens = seen.where("_i = 1").select(F.col("_b").alias("_nb"), F.struct("text", "fingerprint").alias("_opens"))
    lead = follow.join(opens, "_nb").select(F.col("_b").alias("_k"), "_opens")
    out = seen.join(lead, F.col("_b") == F.col("_k")).withColumn("_n", F.coalesce("_next", "_opens"))
    return out.select("doc_id", "text", "fingerprint", F.col("_n.text").alias("next_text"), F.col("_n.fingerprint").alias("next_fingerprint"))


def op10(docs: DataFrame) -> DataFrame:
    rows = with_next(fingerprinted(docs))
    n = F.length("text")
    k = F.floor(n / 2).cast("int")
    rows = rows.withColumn("_e", F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("next_text"), F.lit(1), k)))
    rows = rows.withColumn("edited_fingerprint", wide(canonical(F.col("_e"))))
    same = lambda a, b: F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0)
    return rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("_e").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", same("fingerprint", "edited_fingerprint").alias("near_edited"), same("fingerprint", "next_fingerprint").alias("near_next"))
