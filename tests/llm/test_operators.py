"""The ten operators against brute force, exact round trips and edge cases."""

import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import chat, fingerprints, lines, mixing, near, neighbours, packing, substrings, suffixes, toxicity
from strandline.llm.queries import queries
from strandline.session import ship_package

WORDS = [f"w{i * 7919 % 9973}" for i in range(3000)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, first int, n int"


def fixture():
    p = lambda a, n: " ".join(WORDS[a : a + n])
    base = p(0, 160)
    texts = [base, base, base.replace(WORDS[80], "changed"), p(300, 80) + " " + p(20, 70) + " " + p(500, 90), p(600, 4), "", None, "x", p(700, 400) + "\n" + p(700, 400), "é" * 300, "ab" * 200, p(20, 49), base + " " + p(1500, 30)]
    texts += [p(1600, 120) + "\nThe shared line of every document is long enough to be compared here\n" + p(1800 + 15 * i, 12) for i in range(6)]
    return [(i * 3, t, "en", ["a", "b", None][i % 3], None if t is None else len(t), 1, 2, 3) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = fixture()
    return spark.createDataFrame([*rows, rows[3]], SCHEMA).repartition(3)  # one row twice, clashing names


@pytest.fixture(scope="module")
def empty(spark):
    ship_package(spark)
    return spark.createDataFrame([], SCHEMA)


def tokens(t):
    return re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())


def all_rows():
    return [*fixture(), fixture()[3]]


def test_suffix_array(docs):
    raw = [(r[0], (r[1] or "").encode()) for r in all_rows()]
    seen = collections.Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = []
    for d, b in raw:
        m = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                m[i : i + 200] = b"\1" * 200
        want.append((d, len(b), sum(m), len(re.findall(b"\1+", bytes(m))), hashlib.sha256(bytes(x for x, y in zip(b, m, strict=True) if not y)).hexdigest()))
    assert sorted(tuple(r) for r in suffixes.op1(docs).collect()) == sorted(want)
    hot = suffixes._applied(docs, 200, 32, False, hot=1).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in hot.collect()) == sorted(want)


def test_corpus_order():
    import numpy as np

    rnd = np.random.default_rng(3)
    for letters in (2, 4, 26):
        texts = [bytes(rnd.integers(97, 97 + letters, size=n).astype(np.uint8)) for n in (1, 5, 300, 40, 0, 700)]
        texts += [texts[2], texts[5][100:500], texts[2] + texts[5], b"\0\0a" * 30]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        length = np.array([len(t) for t in texts])
        begin = np.cumsum(length) - length
        first, second = suffixes.corpus_order(raw, begin, length)
        suffix = [texts[i][k:] for i in range(len(texts)) for k in range(len(texts[i]))]
        plain = {s: r for r, s in enumerate(sorted(set(suffix)))}  # a plain suffix array, equal suffixes alike
        keys = sorted(set(zip(first.tolist(), second.tolist(), strict=True)))
        mine = {k: r for r, k in enumerate(keys)}
        assert [mine[k] for k in zip(first.tolist(), second.tolist(), strict=True)] == [plain[s] for s in suffix]
        assert len(suffixes.phrases_of(raw, begin, length)[0]) > len(texts)


def test_substrings(docs):
    rows = [(r[0], tokens(r[1])) for r in all_rows()]
    first = {}
    for d, w in sorted(rows, key=lambda r: r[0]):
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    want = []
    for d, w in rows:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone |= set(range(i, i + 50))
        want.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    assert sorted(tuple(r) for r in substrings.op4(docs).collect()) == sorted(want)


def test_near_duplicates(docs):
    sets = {}
    for r in all_rows():
        w = [x.lower() for x in tokens(r[1])]
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    comp = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    comp[a] = min(comp[a], comp[b])
    want = sorted((r[0], len(sets[r[0]]), comp[r[0]], comp[r[0]] == r[0]) for r in all_rows())
    assert sorted(tuple(r) for r in near.op3(docs).collect()) == want
    kept = near.near_unique(docs)
    assert kept.columns == docs.columns and kept.count() == len({r[0] for r in kept.select("doc_id").collect()})


def test_near_duplicates_in_a_crowd(spark):
    """Pairs at the threshold among hundreds of documents that are all but as close to them, each link compared with brute force."""
    draw = random.Random(5)
    texts = []
    for i in range(400):
        out = [f"c{j}" for j in range(800)]
        for j in draw.sample(range(2, 800, 5), 8):
            out[j] = f"d{i}x{j}"
        texts.append(" ".join(out))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 300 < len(set(root)) < 400
    got = near.op3(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(root))


def test_lines(docs):
    assert lines.edit_distance("kitten", "sitting", 9) == 3 and lines.edit_distance("abc", "xyz", 2) == 3 and lines.edit_distance("ab" * 50, "ba" * 50, 9) == 2
    out = {(r.row.doc_id, r.kept) for r in lines.dedup(docs).collect()}
    shared = "The shared line of every document is long enough to be compared here"
    assert sum(shared in (k or "") for _, k in out) == 1
    assert (12, "x") not in out and (21, "x") in out and (18, None) in out


def test_lines_in_a_crowd(spark):
    """Hundreds of lines share blocks and few are similar: every similar pair that a block holds in fitting places is found."""
    draw = random.Random(3)
    base = " ".join(f"word{j * 7919 % 997:03}" for j in range(24))
    texts = []
    for i in range(300):
        out = list(base)
        for j in draw.sample(range(110, len(base)), 14):
            out[j] = draw.choice("abcdefghijklmnopqrstuvwxyz")
        texts.append("".join(out))
    forms = [lines.normal(t) for t in texts]
    _, _, norm, _, chars, sketch = lines.parsed(texts)
    marks = np.frombuffer(b"".join(sketch), np.uint64).reshape(-1, lines.LEAST)
    blocks = collections.defaultdict(list)
    for rows, key, place in lines.gram_pairs(marks, chars):
        for r, x, p in zip(rows.tolist(), key.tolist(), place, strict=True):
            blocks[x].append((r, p))
    root = list(range(len(texts)))
    pairs = {(a, b) for held in blocks.values() for a, p in held for b, q in held if a < b and lines.meets(np.array([p]), np.array([q]), 0.9)[0]}
    for a, b in pairs:
        if root[a] != root[b] and lines.similar(forms[a], forms[b], 0.9):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    assert 100 < len(set(root)) < 295
    got = lines.removed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in got.collect()) == [i for i, r in enumerate(root) if i != r]


def test_crowds_make_no_pairs(spark, monkeypatch):
    """What a crowded region or block holds stays in proportion to its rows: its pairs are never rows."""
    from strandline.llm import _grouping

    ship_package(spark)
    sizes, plain = [], _grouping.settle

    def counted(df):
        out = plain(df)
        sizes.append(out.count())
        return out

    for module in (_grouping, near, lines):
        monkeypatch.setattr(module, "settle", counted)
    draw, n = random.Random(7), 700
    texts = []
    for i in range(n):
        out = [f"c{j}" for j in range(800)]
        for j in draw.sample(range(2, 800, 5), 10):
            out[j] = f"d{i}x{j}"
        texts.append(" ".join(out))
    got = near.op3(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert got.where("kept").count() > 0.9 * n and max(sizes) <= near.TREES * (near.NEIGHBOURS + near.CROWD) * n
    base, rows = " ".join(f"word{j * 7919 % 997:03}" for j in range(24)), []
    for i in range(n):
        out = list(base)
        for j in draw.sample(range(110, len(base)), 18):
            out[j] = draw.choice("abcdefghijklmnopqrstuvwxyz")
        rows.append((i, "".join(out)))
    del sizes[:]
    lines.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).count()
    assert max(sizes) <= 10 * (2 * lines.REACH + 2) * n


def test_judges():
    """What is set aside before the comparison is never similar, what passes near's is."""
    import zlib

    draw = random.Random(11)
    texts = ["".join(draw.choice("abcde \u597d") for _ in range(80)) for _ in range(4)] + ["", "a"]
    for t in texts[:4]:
        for edits in (1, 4, 8, 9, 12, 20):
            out = list(t)
            for _ in range(edits):
                k = draw.randrange(len(out))
                out[k : k + draw.choice([0, 1, 1])] = draw.choice(["", "x", "b"])
            texts.append("".join(out))
    i, j = np.triu_indices(len(texts), 1)
    may, same = lines.judged(0.9)([zlib.compress(t.encode()) for t in texts])
    like = [lines.similar(texts[a], texts[b], 0.9) for a, b in zip(i, j, strict=True)]
    assert sum(like) > 12 and all(may(i, j)[like]) and [same(a, b) for a, b in zip(i, j, strict=True)] == like
    sets = [np.unique(np.array(draw.sample(range(60), 40 + k % 20), "<u8")).tobytes() for k in range(30)]
    i, j = np.triu_indices(len(sets), 1)
    assert near.judged(60)(sets)[0](i, j).tolist() == [near.similar(60)(sets[a], sets[b]) for a, b in zip(i, j, strict=True)]


def test_a_pair_is_judged_in_one_block():
    """Of the blocks in which two lines meet, exactly one goes through the pair."""
    draw, base, texts = random.Random(5), " ".join(WORDS[40:60]), []
    for _ in range(60):
        out = list(base)
        for k in draw.sample(range(len(base)), draw.choice([1, 3, 6])):
            out[k] = draw.choice("abcxyz")
        texts.append("".join(out))
    _, _, _, _, chars, sketch = lines.parsed([*texts, "a" * 40, "a" * 41])
    blocks = collections.defaultdict(list)
    for rows, key, place in lines.gram_pairs(np.frombuffer(b"".join(sketch), np.uint64).reshape(-1, lines.LEAST), chars):
        for r, k, p in zip(rows.tolist(), key.tolist(), place.tolist(), strict=True):
            blocks[k].append((r, p))
    met, judged = collections.Counter(), collections.Counter()
    for k, held in blocks.items():
        rows, place = [r for r, _ in held], np.array([p for _, p in held], np.uint64)
        c = {"key": np.full(len(rows), k, np.uint64).view(np.int64), "chars": chars[rows], "sketch": np.array([sketch[r] for r in rows], object)}
        i, j = np.triu_indices(len(rows), 1)
        fit = lines.meets(place[i], place[j], 0.9)
        i, j = i[fit], j[fit]
        pairs = [tuple(sorted((rows[x], rows[y]))) for x, y in zip(i, j, strict=True)]
        met.update(pairs)
        judged.update(x for x, own in zip(pairs, lines.firsts(0.9)(c)(i, j), strict=True) if own)
    assert max(met.values()) > 3 and judged == dict.fromkeys(met, 1)


def test_dropped_tables_are_let_go(spark):
    """What Python has dropped is told to the JVM before its collection, not when py4j's thread next looks."""
    from strandline.llm._common import let_go

    waiting, told = spark.sparkContext._gateway._gateway_client.finalizer_deque, []

    class Client:
        def garbage_collect_object(self, target, enqueue):
            told.append(target)

    for k in range(50):
        waiting.appendleft((Client(), k))
    let_go(spark)
    assert sorted(told) == list(range(50)) and not waiting


def test_parts_of_a_crowd(spark, monkeypatch):
    """A group of more than one part, by rows or by bytes, gives the same components."""
    from strandline.llm import _grouping

    ship_package(spark)
    rows = spark.createDataFrame([(g, 100 * g + i, 100 * g + i) for g in range(3) for i in range(40)], "g long, node long, label long").repartition(2)
    forms = lambda nodes: nodes.select(F.col("node").alias("id"), F.pmod("node", F.lit(4)).cast("string").cast("binary").alias("payload"))
    judge = lambda x: (lambda i, j: np.array([x[a] == x[b] for a, b in zip(i, j, strict=True)], bool), lambda a, b: True)
    for part, size in ((1 << 12, 1 << 24), (16, 1 << 24), (1 << 12, 100)):
        monkeypatch.setattr(_grouping, "PART", part)
        monkeypatch.setattr(_grouping, "PART_BYTES", size)
        links = _grouping.rest_links(rows, ["g"], ["node"], forms, judge, F.lit(10), lambda c, i, j: np.ones(len(i), bool))
        got = {r.node: r.label for r in _grouping.components(links).collect()}
        assert got == {100 * g + i: 100 * g + i % 4 for g in range(3) for i in range(40)}


def test_fuzzy_lines(spark):
    ship_package(spark)
    a = " ".join(WORDS[:60])
    df = spark.createDataFrame([(1, a), (2, a.replace(WORDS[30], "other")), (3, " ".join(WORDS[100:160])), (4, a.upper() + "!!")], "doc_id long, text string")
    kept = {r.row.doc_id: r.n_removed for r in lines.dedup(df).collect()}
    assert kept[1] == 0 and kept[3] == 0 and kept[4] == 1


def test_changed_lines(spark):
    ship_package(spark)
    a, b = " ".join(WORDS[:60]), " ".join(WORDS[200:210])
    han = "".join(chr(0x4E00 + i * 7919 % 9973) for i in range(40))
    rows = [(1, a), (2, a.replace(WORDS[30], "other")), (3, b), (4, b.replace(WORDS[204], WORDS[204] + "s")), (5, han), (6, han[:20] + "\u3042" + han[21:]), (7, "ha" * 60), (8, "ha" * 61), (9, " ".join(WORDS[400:430])), (10, " ".join([*WORDS[400:415], *WORDS[600:615]]))]
    kept = {r.row.doc_id: r.n_removed for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1, 7: 0, 8: 1, 9: 0, 10: 0}


def test_short_lines(spark):
    import corpus_pipeline

    ship_package(spark)
    text = "All rights reserved\n\n***\n" + " ".join(WORDS[:40])
    rows = [(1, text), (2, text), (3, "ALL RIGHTS RESERVED.\nall rights deserved"), (4, "\n--\n"), (5, "好\n" + " ".join(WORDS[50:80])), (6, "好\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: (r.n_removed, r.kept) for r in lines.dedup(df).collect()}
    assert got == {1: (0, text), 2: (2, "\n***"), 3: (1, "all rights deserved"), 4: (0, rows[3][1]), 5: (0, rows[4][1]), 6: (1, "x")}
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_lines(spark, df, "").collect()) == [1, 3, 4, 5, 6]


def thue_morse(n):
    """Two texts that every polynomial hash modulo 2**64 takes for one."""
    odd = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[x] for x in odd), "".join("ba"[x] for x in odd)


def test_structured_texts_stay_apart(spark):
    ship_package(spark)
    a, b = thue_morse(1024)
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert all(r.kept for r in near.op3(df).collect())
    before, after = " ".join(WORDS[:30]), " ".join(WORDS[30:60])
    middle = spark.createDataFrame([(1, f"{before} {a} {after}"), (2, f"{before} {b} {after}")], "doc_id long, text string")
    assert {r.n_removed for r in substrings.op4(middle).collect()} == {0}
    words = [" ".join({"a": "left", "b": "right"}[c] for c in t) for t in (a, b)]
    assert {r.n_removed for r in lines.op5(spark.createDataFrame([(1, words[0]), (2, words[1])], "doc_id long, text string")).collect()} == {0}


def test_mixing(docs):
    got = mixing.op2(docs).collect()
    size = collections.Counter()
    for r in all_rows():
        size[r[3]] += len(tokens(r[1]))
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([size[s] for s in order], [5, 2, 1], 1.5), strict=True))
    assert abs(sum(goal.values()) - 1.5 * sum(size.values())) < 1e-6
    by = {r[0]: r[3] for r in all_rows()}
    for s in order:
        taken = sum(r.taken for r in got if by[r.doc_id] == s)
        assert taken <= goal[s] + 1 and goal[s] - taken <= 10
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op2(docs.repartition(5)).collect()))


def test_fit():
    import random

    rnd = random.Random(7)
    for _ in range(200):
        lengths = rnd.sample(range(1, 400), rnd.randint(1, 12))
        counts = [rnd.randint(1, 20) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + k * n for s in sums for k in range(c + 1)} if len(sums) < 4000 else {s + k * n for s in range(sum(x * y for x, y in zip(lengths, counts, strict=True))) if s in sums for k in range(c + 1)}
        budget = rnd.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(t * n for t, n in zip(take, lengths, strict=True)) == max(s for s in sums if s <= budget)
    big = mixing.fit([3, 700, 20_000], [10**6, 10**5, 10**4], 150_000_001)
    assert 150_000_001 - sum(t * n for t, n in zip(big, [3, 700, 20_000], strict=True)) <= 2


def test_neighbours(spark):
    ship_package(spark)
    import random

    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(130)] + [(130, None), (131, [0.0] * 8), (132, [float("nan")] * 8), (133, [None] * 8), (140, [0.5] * 8), (141, [0.5] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = [(i, v) for i, v in rows if i is not None and (i < 130 or i >= 140)]
    want = set()
    for q, x in ok:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ok if i != q)[:20]
            want |= {(q, k + 1, i) for k, (_, i) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id) for r in neighbours.op6(df).collect()} == want


def test_chat(spark):
    ship_package(spark)
    rows = [(1, 0, "user", "<|end|>\n \\<[x"), (1, 1, "assistant", "</s>\\"), (2, None, None, None), (2, 0, "assistant", ""), (None, 1, "assistant", "é<")]
    got = {r.conv_id: r for r in chat.op8(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n<|end|>\n \\<[x\nassistant\n</s>\\\n") and got[1].loss_sha256 == sha("</s>\\")
    assert got[2].turns_sha256 == sha("\n\nassistant\n\n") and got[2].loss_chars == 0 and got[None].loss_chars == 2
    assert got[-1].loss_sha256 == sha(chat.CONTROL[1][3]) and not got[-1].rewrites_history
    assert "</s>" not in chat.template([(r, t) for _, _, r, t in chat.CONTROL])
    assert chat.render([("user", "a"), ("assistant", "b")], lambda ts: f"{len(ts)}:" + "".join(t for _, t in ts)).rewrites_history


def test_neighbours_of_many_dimensions(spark):
    ship_package(spark)
    rnd = neighbours.np.random.default_rng(5)
    x = rnd.normal(size=(60, 4096)) + 3.0
    df = spark.createDataFrame([(i, v.tolist(), i) for i, v in enumerate(x)], "vec_id long, embedding array<double>, h int")
    got = {(r.query_id, r["rank"]): r.vec_id for r in neighbours.op6(df).collect()}
    for q in (0, 20, 40):
        s = x @ x[q]
        best = sorted((i for i in range(60) if i != q), key=lambda i: (-s[i], i))[:20]
        assert [got[q, k + 1] for k in range(20)] == best
    codes = rnd.integers(120, 128, size=(3, 4096)).astype(neighbours.np.int8)
    assert (neighbours.products(codes, codes) == codes.astype(neighbours.np.int64) @ codes.T.astype(neighbours.np.int64)).all()


def test_neighbours_among_equal_vectors(spark):
    ship_package(spark)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, 0.5]) for i in range(900)] + [(7, [1.0, 2.0, 3.0]), (20, [9.0, 9.0, 9.0])]
    got = collections.defaultdict(list)
    for r in neighbours.op6(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q in (40, 60, 880):
        x = dict(rows)[q]
        best = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for i, v in rows if i != q)[:20]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_stages_on_odd_rows(docs, empty, spark):
    import corpus_pipeline

    ship_package(spark)
    base = "/root/testdata/sf0.001"
    odd = docs.unionByName(spark.createDataFrame([(None, "some text without an id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)], SCHEMA))
    for table in (odd, empty):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, base)
            assert now.columns == table.columns
        corpus_pipeline.STAGES[-1][1](spark, now, base).count()
    near_kept = corpus_pipeline.dedup_near(spark, odd, base)
    sets = {}
    for r in odd.collect():
        w = [x.lower() for x in tokens(r.text)]
        sets[r.doc_id, r.text] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    kept = [(r.doc_id, r.text) for r in near_kept.collect()]
    full = [k for k in kept if sets[k]]
    assert all(100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]) for i, a in enumerate(full) for b in full[i + 1 :])
    assert sum(not sets[k] for k in kept) == sum(not sets[r.doc_id, r.text] for r in odd.collect())
    mixed = corpus_pipeline.mix_sources(spark, odd, base).groupBy("doc_id", "text", "source").count().collect()
    sizes = collections.Counter()
    for r in odd.collect():
        sizes[r.source] += len(tokens(r.text))
    goal = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), mixing.targets([sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))], [5, 2, 1], 1.5), strict=True))
    for s in sizes:
        assert 0 <= goal[s] + 0.5 - sum(r["count"] * len(tokens(r.text)) for r in mixed if r.source == s) <= 10


def test_line_recall(spark):
    """Candidates against brute force: changed lines of the smallest table that are still similar."""
    import random

    ship_package(spark)
    rnd = random.Random(4)
    every = sorted({x for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for x in (r.text or "").split("\n") if 8 <= len(x.split()) <= 80})
    rnd.shuffle(every)
    rows, want = [], 0
    for i, line in enumerate(every[:400]):
        w = line.split()
        k = rnd.randrange(len(w))
        other = " ".join([*w[:k], w[k] + "s" if i % 2 else rnd.choice(every[0].split()), *w[k + 1 :]])
        a, b = lines.normal(line), lines.normal(other)
        if a != b and min(len(a), len(b)) >= lines.SHORT and lines.similar(a, b, lines.SIMILAR):
            rows += [(2 * want, line), (2 * want + 1, other)]
            want += 1
    gone = {r.doc_id for r in lines.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want > 200 and sum(2 * i + 1 in gone for i in range(want)) >= 0.95 * want


def test_chat_masks_and_roles(spark):
    ship_package(spark)
    texts = ["end", "|", ">", "\n", "<|end|>", "|>\n", "a", "\\", "[", "x|>"]
    rows = [(i, 0, "assistant", t) for i, t in enumerate(texts)] + [(50, 0, "a|>\nb", "t"), (50, 1, "|\\|<[", "u"), (-1, 0, "user", "own")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    for c in chat.formatted(df).collect():
        own = [(r, t) for i, _, r, t in rows if i == c.conv_id]
        assert chat.read_back(c.formatted) == own
        loss = [c.formatted[a:z] for a, z in zip(c.loss_starts, c.loss_ends, strict=True)]
        assert loss == [chat.escape(t) for r, t in own if r == "assistant"]
        for (a, _), (role, _) in zip(zip(c.loss_starts, c.loss_ends, strict=True), own, strict=False):
            assert a == len(chat.OPEN + chat.escape_role(role) + chat.CLOSE)
    assert sorted(r.n_turns for r in chat.op8(df).where("conv_id = -1").collect()) == [1, 2]
    system_first = lambda ts: "".join(f"<{r}>{chat.escape(t)}</{r}>" for r, t in ts)
    f = chat.render([("user", "q"), ("assistant", "</assistant>")], system_first)
    assert [f.text[a:z] for a, z in f.loss] == [chat.escape("</assistant>")]


def test_packing(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = {r[0]: [*tok.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in fixture()}
    got = packing.op9(docs).collect()
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
    assert sum(r.length for r in got) == sum(map(len, ids.values())) + len(ids[9])
    for s in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length) for r in got if r.sequence_id == s)
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_encoder_tells_equal_hashes_apart():
    import public_tokenizers

    from strandline.llm._bpe import Encoder

    enc = Encoder(public_tokenizers.path(packing.TOKENIZER))
    a, b = thue_morse(1024)
    for texts in ([a, b], [f"so {a} it", f"so {b} it", "so it is"], ["so it", "it so"], [b]):
        ids, off = enc.encode(texts)
        assert [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:], strict=True)] == [enc.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_little_padding():
    import random

    rnd = random.Random(2)
    for most in (30, 700, 2047):
        lengths = [rnd.randint(1, most) for _ in range(3000)]
        out = packing.assign(lengths)
        assert len(out) == -(-sum(lengths) // packing.CAPACITY)
        pieces = sorted(p for b in out for p in b)
        assert all(sum(n for _, _, n in b) <= packing.CAPACITY for b in out)
        whole = {i: sum(n for j, _, n in pieces if j == i) for i in range(0, 3000, 300)}
        assert all(whole[i] == lengths[i] for i in whole)


def test_fingerprints(docs, spark):
    rows = sorted(((r[0], r[1] or "") for r in all_rows()), key=lambda r: r[0])
    got = fingerprints.op10(docs).collect()
    by = dict(rows)
    once = sorted(by)
    for r in got:
        t, i = by[r.doc_id], once.index(r.doc_id)
        if r.doc_id != 9:
            k = len(t) // 2
            e = t[: len(t) - k] + by[once[(i + 1) % len(once)]][:k]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
    pairs = spark.createDataFrame([(1, "Stra\u00dfe  e\u0301"), (2, " STRASSE \u00c9\n"), (3, "strasse e"), (4, "a\u0302\u0323"), (5, "\u1ead")], "doc_id long, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprints.fingerprinted(pairs).collect()}
    assert f[1] == f[2] != f[3] and f[4] == f[5]


def test_clashing_fingerprints(spark, monkeypatch):
    """Texts of one hash get numbers; to tell that there are any, no text is shuffled."""
    docs = spark.createDataFrame(list(enumerate(["b", "a", "A ", "c", "b"])), "doc_id long, text string")
    plans = []

    def settled(df, own=fingerprints.settle):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    monkeypatch.setattr(fingerprints, "settle", settled)
    plain = [r.fingerprint for r in fingerprints.fingerprinted(docs).orderBy("doc_id").collect()]
    assert len(set(plain)) == 3 and plain[0] == plain[4] and plain[1] == plain[2]
    assert not [x for p in plans for x in re.findall(r"hashpartitioning\([^)]*", p) if "canon" in x]
    monkeypatch.setattr(fingerprints, "wide", lambda canon: F.substring(F.concat(F.lit("same"), canon), 1, 4))
    assert [r.fingerprint for r in fingerprints.fingerprinted(docs).orderBy("doc_id").collect()] == ["same#1", "same", "same", "same#2", "same#1"]


def test_toxicity(spark):
    ship_package(spark)
    bad = ["scoundrel", "villain"]
    text = lambda i: " ".join(WORDS[(i * 13) % 900 : (i * 13) % 900 + 20]).replace("w", "wo")
    alpha = lambda s: re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], s)
    rows = [(i, alpha(text(i)) + (f" {bad[i % 2]}." if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(400)]
    hidden = [(1000, "some sc0undrel here", 1), (1001, "some v i l l a i n here", 1), (1002, "scoooundrel", 1), (1003, "plain words", 0), (1004, "", 0), (1005, None, 0)]
    docs = spark.createDataFrame([r[:2] for r in rows + hidden], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.op7(docs, labels).collect()}
    assert all(got[d].predicted == t for d, _, t in rows + hidden)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())


def test_hidden_words():
    lm = toxicity.language_model(toxicity.np.ones(toxicity.LETTERS**toxicity.ORDER))
    lexicon = {w: 0.9 for w in ("idiot", "asshole", "ass", "scoundrel", "loser", "god", "idio-")}
    s = toxicity.Scorer(lm, lexicon, 0.02, frozenset({"good"}))
    for w in ("idi07", "asshol3", "a$$", "scooundrel", "idiiot", "losér", "lós3r", "idiiots", "idi07.", "Lóser!"):
        assert s.score(f"some {w} here") > 0.5, w
    for w in ("good", "look", "été", "mp3", "wood."):
        assert s.score(f"some {w} here") < 0.1, w


def test_empty_tables(empty, spark):
    for op in (suffixes.op1, mixing.op2, near.op3, substrings.op4, lines.op5, packing.op9, fingerprints.op10):
        assert op(empty).count() == 0, op
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.op7(empty, labels).count() == 0
    assert neighbours.op6(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert chat.op8(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 1


def test_pipeline(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5 and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
    assert {k.split("_")[0] for k in queries()} == {f"op{i}" for i in range(1, 11)}
    assert json.dumps(sorted(queries()))
