"""7. Toxicity by noisy-channel deobfuscation.

Three parts.  A character language model: 4-gram counts of folded letters over
the whole corpus (a table of fixed size, whose counts grow with the input).
A decoder: a token that mixes letters with digits or symbols, repeats a letter
three times, or is spelt with gaps becomes a lattice of what its characters may stand
for; exact Viterbi search under the language model finds the likeliest readings.  A
lexicon: words and word beginnings whose documents are labelled toxic
significantly more often than others, in different neighbourhoods (so that copies of one
document count once), from a bounded sample of labelled rows (SAMPLE, in hash order of ids); hidden tokens of these rows are decoded first, so restored text is learnt from.
Words of letters alone are read as they stand; one with an equal pair or an
accented Latin letter is looked up without them too, unless the labelled rows
show it to be an ordinary word.

A document's score is one minus the product, over the lexicon entries found in
it, of the odds that each is harmless, starting from the share of toxic rows
that the sample shows among documents without any entry.

Edge cases.  Null and empty texts score that share.  Null ids are scored;
they match no label.  Labels that contradict each other count as the largest.
Repeated rows score alike.  Empty tables: empty result; without labels every
score is 0.  Very long texts and tokens are read whole.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import flat, pieces, settle, tidy

#: At most so many labelled rows train the lexicon.
SAMPLE = 20_000
THRESHOLD = 0.3
LETTERS, ORDER, READINGS = 32, 4, 4
#: Evidence an entry needs, in nats beyond the logarithm of the number of entries in as many documents.
MARGIN = 2.5
MEMO = 100_000
_MASK = (1 << 61) - 1

# What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "%": "o"}
LOOKALIKE = dict(zip("аеорсухіѕԁոαεοτικ", "aeopcyxisdnaeotik", strict=True))
GAPS = " ._-*'~/\\​‌‍﻿­"
_EDGE = ".,;:?\"'()[]{}%&#*…«»“”‘’"
_SPELT = re.compile(r"(?<!\S)[^\W_](?:[ ._\-*~/]{1,3}(?:[^\W_]|[@$!|])){2,}(?!\w)")
_SIGN = r"[0-9@$!|+(€£¡*#%._\-'~\u200b-\u200d\ufeff\u00ad]"
#: Where a token hides letters: signs between letters, a sign before letters or behind one (beyond sentence punctuation), a letter three times, letters of another script beside Latin ones.
_ODD = re.compile(rf"[^\W\d_]{_SIGN}+[^\W\d_]|(?<!\S)[0-9@$!|+(€£¡*]+[^\W\d_]|[^\W\d_][0-9@$|+€£*#%]|([^\W\d_])\1\1|[a-z][\u0370-\u04ff]|[\u0370-\u04ff][a-z]")

#: Where a word of letters may hide another: a letter twice, an accented Latin letter.
_SOFT = re.compile(r"([^\W\d_])\1|[\u00e0-\u00f6\u00f8-\u024f\u1e00-\u1eff]")
_RUN = re.compile(r"(.)\1+")
_TRIPLE, _OTHER_SCRIPT = re.compile(r"([^\W\d_])\1\1"), re.compile("[\u0370-\u04ff]")
_LETTERS = re.compile(r"[^\W\d_]+")


def bare(word: str) -> str:
    """A word without accents and with each run of a letter as one."""
    return _RUN.sub(r"\1", "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)))


def fold_table() -> np.ndarray:
    """Code point -> letter 1 to 26, 27 for other letters, 0 for what is none."""
    out = np.zeros(0x3000, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        if c.isalpha():
            base = unicodedata.normalize("NFD", c.lower())[0]
            out[i] = ord(base) - 96 if "a" <= base <= "z" else 27
    out[-1] = 27  # whatever lies beyond
    return out


def letter_counts(docs: DataFrame) -> np.ndarray:
    """4-gram counts over all texts; at most LETTERS ** ORDER rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, total = fold_table(), np.zeros(LETTERS**ORDER, np.int64)
        for b in batches:
            data, off = flat(b.column(0))
            for a, z in pieces(off, 1 << 19):
                text = data[off[a] : off[z]].tobytes().decode("utf-8", "replace")
                cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                x = fold[np.minimum(cp, len(fold) - 1)].astype(np.int32)
                x = np.concatenate([np.zeros(ORDER - 1, np.int32), x])
                gram = x[3:] + LETTERS * (x[2:-1] + LETTERS * (x[1:-2] + LETTERS * x[:-3]))
                total += np.bincount(gram, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(count), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(LETTERS**ORDER, np.float64)
    out[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(letter | three before), interpolated with shorter contexts."""
    p = np.full(LETTERS, 1.0 / LETTERS)
    for k in range(1, ORDER + 1):
        c = counts.reshape(-1, LETTERS**k).sum(axis=0).reshape(-1, LETTERS)
        lower = np.tile(p.reshape(-1, LETTERS), (LETTERS, 1)) if k > 1 else p.reshape(1, -1)
        n, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        lam = n / np.maximum(n + 5.0 * np.maximum(kinds, 1), 1e-9)
        p = lam * c / np.maximum(n, 1) + (1 - lam) * lower
    return np.log(np.maximum(p, 1e-12)).astype(np.float32).reshape(-1)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per character: the letters it may stand for ('' for none) with their costs."""
    out, before = [], ""
    for c in token:
        c = LOOKALIKE.get(c, c)
        if c.isalpha():
            arcs = [(c, 0.0)]
            base = unicodedata.normalize("NFD", c)[0]
            if base != c and "a" <= base <= "z":
                arcs.append((base, 0.5))
            if c == before:
                arcs = [(c, 1.0), ("", 0.2)]
        else:
            arcs = [(x, 0.5) for x in LEET.get(c, "")]
            if c in GAPS or c == before:
                arcs.append(("", 0.3))
            if not arcs:
                arcs = [("", 4.0)]
        out.append(arcs)
        before = c
    return out


def readings(token: str, lm: np.ndarray, n: int = READINGS) -> list[str]:
    """The ``n`` likeliest letter strings behind a token, best first: exact Viterbi search over its lattice.

    A state is the last three letters; of each the n best paths are kept, as chains of letters.
    """
    states: dict[int, list[tuple]] = {0: [(0.0, 0, None)]}  # three letters as a number -> (cost, hash of the text, chain)
    for arcs in lattice(token):
        new: dict[int, list[tuple]] = {}
        for ctx, paths in states.items():
            for letter, pay in arcs:
                if letter:
                    f = _fold(letter)
                    step, key = pay - float(lm[ctx * LETTERS + f]), (ctx * LETTERS + f) % LETTERS**3
                    new.setdefault(key, []).extend([(c + step, (h * 1_000_003 ^ ord(letter)) & _MASK, (chain, letter)) for c, h, chain in paths])
                else:
                    new.setdefault(ctx, []).extend([(c + pay, h, chain) for c, h, chain in paths])
        states = {k: _best(paths, n) for k, paths in new.items()}
    ends = _best([(c - float(lm[ctx * LETTERS]), h, chain) for ctx, paths in states.items() for c, h, chain in paths], n)
    out = []
    for _, _, chain in ends:
        text = []
        while chain is not None:
            chain, letter = chain
            text.append(letter)
        out.append("".join(reversed(text)))
    return out


def _best(paths: list[tuple], n: int) -> list[tuple]:
    """The n cheapest paths of different texts; ties by text hash."""
    out: list[tuple] = []
    seen = set()
    for p in sorted(paths, key=lambda p: p[:2]) if len(paths) > 1 else paths:
        if p[1] not in seen:
            seen.add(p[1])
            out.append(p)
            if len(out) == n:
                break
    return out


@functools.lru_cache(1 << 16)
def _fold(letter: str) -> int:
    base = unicodedata.normalize("NFD", letter)[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27


def entries(word: str) -> list[str]:
    """What a word may match in the lexicon: itself, and its beginnings."""
    return [word, *(word[:k] + "-" for k in (4, 5, 6) if len(word) > k)]


def plain(token: str) -> str:
    return token.strip(_EDGE).rstrip("!").lstrip("¡¿")


def bare_entries(lexicon: Iterable[str]) -> dict[str, list[str]]:
    """Entries by their bare form."""
    out: dict[str, list[str]] = {}
    for e in lexicon:
        out.setdefault(bare(e), []).append(e)
    return out


class Scorer:
    """Scores texts with a model; what an odd token gives is remembered."""

    def __init__(self, lm: np.ndarray, lexicon: dict[str, float], base: float, ordinary: frozenset[str] = frozenset()):
        self.lm, self.lexicon, self.base, self.memo = lm, lexicon, base, {}
        self.ordinary, self.bare, self.soft, self.starts = ordinary, bare_entries(lexicon), {}, {}
        self.firsts = {e[:2] for e in self.bare}
        self.plain = None
        if lexicon:
            import ahocorasick

            self.plain = ahocorasick.Automaton()
            for e in {e.rstrip("-") for e in lexicon}:
                self.plain.add_word(e, len(e))
            self.plain.make_automaton()

    def literal(self, text: str) -> set[str]:
        """Entries that stand in a lower-case text as they are: at the start of a run of letters."""
        hits = set()
        if self.plain is not None:
            for last, n in self.plain.iter(text):
                a, z = last - n + 1, last + 1
                if a and text[a - 1].isalpha():
                    continue
                if z < len(text) and text[z].isalpha():
                    hits.add(text[a:z] + "-")
                else:
                    hits.add(text[a:z])
        return hits

    def restored(self, token: str) -> tuple[str, ...]:
        """Entries behind a token that hides letters."""
        got = self.memo.get(token)
        if got is None:
            forms = {plain(token), token.strip(_EDGE)}
            got = tuple({e for f in forms for w in readings(f, self.lm) for e in entries(w) if e in self.lexicon})
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = got
        return got

    def begins(self, two: str) -> bool:
        """Whether the bare form of a word with this beginning may be an entry's."""
        got = self.starts.get(two)
        if got is None:
            form = bare(two)
            got = self.starts[two] = len(form) < 2 or form[:2] in self.firsts
        return got

    def softened(self, word: str) -> tuple[str, ...]:
        """Entries that a word of letters is but for doubled letters and accents."""
        got = self.soft.get(word)
        if got is None:
            got = () if word in self.ordinary else tuple({e for b in entries(bare(word)) for e in self.bare.get(b, ())})
            if len(self.soft) >= MEMO:
                self.soft.clear()
            self.soft[word] = got
        return got

    def spelt(self, stretch: str) -> set[str]:
        """Entries inside a stretch of single characters with gaps between."""
        out = set()
        for r in readings(stretch, self.lm):
            out.add(r)
            if self.plain is not None:
                out |= {r[last - n + 1 : last + 1] for last, n in self.plain.iter(r) if n >= 4}
        return out

    def hits(self, text: str) -> set[str]:
        """Lexicon entries in a text, as it is or restored."""
        text = text.lower()
        hits = self.literal(text)
        for token in odd(text):
            hits.update(self.restored(token))
        if self.bare:
            for word in set(_LETTERS.findall(text)):
                if self.begins(word[:2]) and _SOFT.search(word):
                    hits.update(self.softened(word))
        for m in _SPELT.finditer(text):
            hits |= self.spelt(m[0])
        return hits & self.lexicon.keys()

    def score(self, text: str) -> float:
        clean = 1.0 - self.base
        for h in sorted(self.hits(text)):
            clean *= 1.0 - self.lexicon[h]
        return 1.0 - clean


def odd(text: str) -> Iterator[str]:
    """Different tokens of a lower-case text that may hide letters."""
    every = _TRIPLE.search(text) or _OTHER_SCRIPT.search(text)  # then words of letters alone may, too
    for token in set(text.split()):
        if not every and (token.isalpha() or token.lstrip("(\"'").rstrip(".,;:?!)\"'").isalpha()):
            continue
        if _ODD.search(token):
            yield token


def training(remainder: Column) -> Column:
    return remainder != 2


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def sample(labels: DataFrame, train: Column | None = None, bound: int = SAMPLE) -> DataFrame:
    """doc_id, toxic of at most ``bound`` labelled rows that may be learnt from, in hash order."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    if train is not None:
        rows = rows.where(train)
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def learn(docs: DataFrame, labelled: DataFrame, lm: np.ndarray) -> tuple[dict[str, float], float, frozenset[str]]:
    """The lexicon with each entry's share of toxic documents, the measured share among documents without any entry, and ordinary words that look like entries but for equal pairs and accents.

    Words are counted as they stand and as decoded: a hidden token or spelt stretch counts as its likeliest reading.
    ``labelled`` holds at most SAMPLE rows, which is why it is broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(labelled), "doc_id").select("text", "toxic")
    rows = settle(rows)  # at most the sample's texts, read three times

    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(lm)  # LETTERS ** ORDER numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded: dict[str, list[str]] = {}

        def behind(token: str) -> list[str]:
            if token not in decoded:
                if len(decoded) >= MEMO:
                    decoded.clear()
                decoded[token] = [e for r in readings(token, model.value, 1) if len(r) >= 4 and r.isalpha() for e in entries(r)]
            return decoded[token]

        for b in batches:
            n, bad = Counter({"": 0}), Counter()
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                if len(n) > 100_000:  # an entry may come in several rows; they are added up
                    yield counted(n, bad)
                    n, bad = Counter({"": 0}), Counter()
                text = text.as_py().lower()
                own = {e for t in set(text.split()) if (w := plain(t)).isalpha() for e in entries(w)}
                for t in {*odd(text), *(m[0] for m in _SPELT.finditer(text))}:
                    own.update(behind(plain(t)))
                own.add("")  # every document has this entry: the totals
                n.update(own)
                if toxic:
                    bad.update(own)
            yield counted(n, bad)

    def counted(n: Counter, bad: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([bad[e] for e in n], pa.int64())], names=["entry", "n", "bad"])

    per = settle(rows.mapInArrow(tidy(count), "entry string, n long, bad long").groupBy("entry").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    total = per.where("entry = ''").collect()
    if not total or not total[0].n:
        return {}, 0.0, frozenset()
    docs_n, bad_n = int(total[0].n), int(total[0].bad)
    rate = min(max(bad_n / docs_n, 1e-4), 0.9)
    # candidates come to the driver only if toxic documents are the greater part: few, whatever the input
    some = per.where((F.col("entry") != "") & (F.col("bad") * 2 > F.col("n")) & (F.col("bad") >= 3)).collect()
    often = sorted(((int(r.n), int(r.entries)) for r in per.groupBy("n").agg(F.count("*").alias("entries")).collect()), reverse=True)  # at most SAMPLE rows
    rivals, seen = {}, 0
    for n, k in often:
        seen += k
        rivals[n] = seen

    def evidence(n: int, bad: int) -> bool:
        """Whether ``bad`` of ``n`` is more than chance gives the best of as many entries as have n documents."""
        p = bad / n
        gain = n * (p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0.0)) if p > rate else 0.0
        return gain >= math.log(rivals[max((k for k in rivals if k <= n), default=min(rivals))]) + MARGIN

    chosen = spark.sparkContext.broadcast(frozenset(r.entry for r in some if evidence(int(r.n), int(r.bad))))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: set[tuple[str, int, int]] = set()
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                words = [plain(t) for t in text.as_py().lower().split()]
                for i, w in enumerate(words):
                    found = entries(w) if w.isalpha() else [e for r in readings(w, model.value, 1) for e in entries(r)] if w and _ODD.search(w) else ()
                    near = None
                    for e in found:
                        if e in chosen.value:
                            near = near or zlib.crc32(" ".join([*words[max(0, i - 1) : i], "|", *words[i + 1 : i + 2]]).encode())
                            out.add((e, near, int(toxic > 0)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in ((0, pa.string()), (1, pa.int64()), (2, pa.int32()))], names=["entry", "near", "toxic"])

    # copies of a document repeat its words with their neighbours: an entry's evidence is its different neighbourhoods
    places = rows.mapInArrow(tidy(contexts), "entry string, near long, toxic int").groupBy("entry", "near").agg(F.max("toxic").alias("toxic"))
    lexicon = {}
    for r in places.groupBy("entry").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect():  # no more than there are in ``chosen``
        n, bad = int(r.n), int(r.bad)
        if bad >= 3 and evidence(n, bad):
            lexicon[r.entry] = (bad + 0.5) / (n + 1.0) * 0.98
    index = bare_entries(lexicon)
    # words of three or more labelled documents, mostly harmless ones: their number is bounded by the sample
    words = per.where((F.col("n") >= 3) & (F.col("bad") * 2 <= F.col("n")) & F.col("entry").rlike(r"(\p{L})\1|[\u00e0-\u00f6\u00f8-\u024f\u1e00-\u1eff]") & ~F.col("entry").endswith("-")).select("entry")
    ordinary = frozenset(r.entry for r in words.toLocalIterator() if any(b in index for b in entries(bare(r.entry)))) if index else frozenset()
    given = spark.sparkContext.broadcast((lm, lexicon, 0.0, ordinary))

    def none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*given.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([not s.hits(t.as_py()) for t in b.column("text")], pa.bool_()), b.column("toxic")], names=["none", "toxic"])

    left = rows.mapInArrow(tidy(none), "none boolean, toxic int").where("none").agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("bad")).first()
    return lexicon, ((left.bad or 0) + 0.5) / (left.n + 1.0), ordinary


def scored(docs: DataFrame, lm: np.ndarray, lexicon: dict[str, float], base: float, ordinary: frozenset[str] = frozenset(), threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted; all other columns stay."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((lm, lexicon, base, ordinary))  # of fixed size, and as long as the sample allows
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([StructField("_row", packed.schema["_row"].dataType), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array([s.score(t.as_py()) for t in b.column("_text")], pa.float64())], names=["_row", "score"])

    out = packed.mapInArrow(tidy(run), schema).select("_row.*", "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def model(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> tuple[np.ndarray, dict[str, float], float, frozenset[str]]:
    lm = language_model(letter_counts(docs))
    return (lm, *learn(docs, sample(labels, train), lm))


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = model(rows, labels, training(remainder(F.col("doc_id"))))
    out = scored(rows, *parts)
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
