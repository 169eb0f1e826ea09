"""Divergence audit, hard negatives and suffix dedup against plain Python."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.llm import divergence, hard_negatives, suffix_dedup
from ratingspark.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string"


# ---------------------------------------------------------------- divergence
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, min_docs, top):
    docs, counts, groups = defaultdict(lambda: defaultdict(int)), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        for t in set(terms):
            docs[lang][t] += 1
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(count, total):
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: share(counts[lang, s], sum(counts[lang, s][t] for t in kept)) for s in sources}
        whole = sum((counts[lang, s] for s in sources), Counter())
        q = share(whole, sum(whole[t] for t in kept))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)}
    return out


LETTERS = [(i, f"Alpha beta{'!' if i % 2 else ' '}GAMMA{i % 5} Ünï ünï 漢字かな x{i % 3}y \x00 kappa" * (1 + i % 4), "en" if i % 3 else "de",
            f"s{i % 7}") for i in range(60)]
EDGES = [(1, None, None, None), (2, "", "en", "lonely"), (3, "zzz", "qq", "a"), (4, "zzz", "qq", "a"), (5, "nothing kept", "xx", "b"),
         (6, "other", "xx", None), (7, "12 34 ~ \n", "xx", "c"), (None, "word " * 50, "en", "s1"), (None, "word " * 50, "en", "s1"),
         (9, "word", "en", "s2"), (10, "ſ İ ß é É " * 9, "en", None)]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_divergence_equals_plain_python(spark, block_bytes):
    rows = LETTERS + EDGES
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("own") for c in ("term", "n", "code", "first", "total", "p")})
    got = [tuple(r) for r in divergence.divergence(docs.repartition(5), block_bytes=block_bytes).collect()]
    assert len(got) == len(set(got)) and set(got) == audited(rows, 3, 200)


def test_divergence_cuts_and_ranks(spark):
    rows = [(i, " ".join(f"t{chr(97 + (i * k) % 17)}{chr(97 + k % 23)}" for k in range(1, 40)), "en", f"s{i % 12}") for i in range(80)]
    got = {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, DOC), min_docs=2, top_terms=5).collect()}
    assert got == audited(rows, 2, 5)
    assert max(r[5] for r in got if r[2] == "term") == 5 and max(r[5] for r in got if r[2] == "pair") == 11


def test_divergence_of_nothing(spark):
    assert divergence.divergence(spark.createDataFrame([], DOC)).count() == 0


def test_terms_of_long_texts(spark):
    rows = [(i, ("abc" * 30_000 + " ") * 3 + "tail" + "é" * 70_000, "en", "ab"[i % 2]) for i in range(4)]
    assert {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, DOC)).collect()} == audited(rows, 3, 200)


def test_few_pairs_are_held(monkeypatch, spark):
    monkeypatch.setattr(divergence, "PAIRS", 4)
    out = divergence.Corrections()
    made = []
    for i in range(50):
        made += list(out.add("en", np.array([i % 20 << 32 | 1, 3]), np.array([i, 1])))
    made += list(out.rows())
    sums = Counter()
    for batch in made:
        for r in batch.to_pylist():
            sums[r["a"], r["b"]] += r["value"]
    assert len(made) > 1 and sums[0, 3] == 50 and sum(sums.values()) == 50 + sum(range(50))


# ---------------------------------------------------------------- hard negatives
VEC = "vec_id long, label long, vector array<long>"


def mined(rows, is_anchor, positives=5, negatives=3):
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows})
    out = set()
    for i, l, v in rows:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            fit = [(-t, k) for t, k, m in scored if m != l and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out |= {(i, j, n, k, -s, t) for n, (t, k) in enumerate(fit, 1)}
    return out


def vectors(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-40, 40, size=(8, dim))
    return [(i, int(rng.integers(0, 4)), (centres[i % 8] + rng.integers(-spread, spread + 1, size=dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("sizes", [dict(), dict(block_rows=40, group_rows=3, blocks_per_task=2)])
def test_hard_negatives_equal_plain_python(spark, sizes):
    rows = vectors(400, 5, 1, 6) + vectors(60, 3, 2, 2)  # two lengths, repeated ids
    rows += [(1000 + i, i % 2, [7, 7, 7, 7, 7]) for i in range(70)] + rows[:5]  # ties and repeated rows
    rows += [(2000, 1, [0, 0, 0, 0, 0]), (2010, 9, [1, 1, 1, 1, 1])]  # no direction; alone in its label
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit(1) for c in ("block", "group", "part", "score", "dim")}).repartition(4)
    got = [tuple(r) for r in hard_negatives.mine(df.select("vec_id", "label", "vector"), F.col("vec_id") % 10 == 0, **sizes).collect()]
    want = mined(rows, lambda i: i % 10 == 0)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_hard_negatives_without_broadcast(spark, monkeypatch):
    rows = vectors(200, 4, 3, 5)
    monkeypatch.setattr(hard_negatives, "small", lambda df, row_bytes: False)
    got = {tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, VEC), F.col("vec_id") % 7 == 0, block_rows=30,
                                                 blocks_per_task=3).collect()}
    assert got == mined(rows, lambda i: i % 7 == 0)


def test_integer_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0]), (None, 1, [1.0]), (3, 1, None), (4, 1, []), (5, 1, [nan]), (6, 1, [inf]), (7, 1, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("vector", F.lit("own"))
    assert [tuple(r) for r in hard_negatives.integer_vectors(df).collect()] == [(1, 1, [128, -1])]
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(hard_negatives.integer_vectors(empty), F.col("vec_id") % 50 == 0).count() == 0


def test_products_beyond_doubles_are_exact(spark):
    big = 1 << 27
    rows = [(0, 1, [big, 1]), (1, 1, [big, 2]), (2, 1, [big, 3]), (3, 2, [big * 9 // 10, 5]), (4, 2, [big * 9 // 10, 6])]
    got = {tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, VEC), F.col("vec_id") == 0).collect()}
    assert got == mined(rows, lambda i: i == 0) and len(got) == 4


def test_tree_bounds_hold_and_skip():
    rng = np.random.default_rng(4)
    points = (rng.integers(-60, 60, size=(20, 16))[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, size=(3000, 16))).astype(np.int64)
    tree = hard_negatives.CoverTree.build(points)
    points, norm = points[tree.order], hard_negatives.CoverTree.augmented(points)[1]
    anchors = points[::100]
    search = hard_negatives.Search(anchors, np.arange(-1, -1 - len(anchors), -1), np.arange(len(anchors)),
                                   np.full(len(anchors), -1 << 60), np.full(len(anchors), 1 << 60), 5)
    below, above = search.bounds(points, tree, norm, 0, len(tree.centre))
    for node in range(len(tree.centre)):
        own = anchors @ points[tree.start[node]:tree.end[node]].T
        assert (below[:, node] <= own.min(axis=1)).all() and (above[:, node] >= own.max(axis=1)).all()
    search.block(np.arange(len(points)), points, tree, norm)
    assert search.opened < len(anchors) * len(points) / 2
    assert (search.score == np.sort(anchors @ points.T, axis=1)[:, :-6:-1]).all()


# ---------------------------------------------------------------- suffix dedup
def cut(rows, length):
    """By every string of the length, brute force."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        out.append((d, len(t), int(gone.sum()), len(edges), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=str)


def removed(df, **options):
    found = suffix_dedup.remove_repeats(df, **options)
    return sorted((tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=str)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    passage = ["".join(rng.choice(list("abcé "), 90)) for _ in range(4)]
    out = []
    for i in range(n):
        own = "".join(rng.choice(list("abcdefghij 漢"), int(rng.integers(0, 200))))
        at = int(rng.integers(0, len(own) + 1))
        part = passage[i % 4][int(rng.integers(0, 30)):int(rng.integers(60, 91))]
        out.append((i, own[:at] + part + own[at:]))
    return out


@pytest.mark.parametrize("length", [1, 3, 13, 30, 47])
@pytest.mark.parametrize("hot_rows", [1000, 2])
def test_suffix_dedup_equals_brute_force(spark, length, hot_rows):
    rows = texts(length, 40) + [(100, None), (101, ""), (None, "x" * 500), (None, "x" * 500), (102, "ab" * 300), (103, "short"),
                                (104, "q" * length), (105, "r" * length), (105, "r" * length)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(df, length=length, passes=3, hot_rows=hot_rows) == cut(rows, length)


def test_suffix_dedup_keeps_columns(spark):
    rows = [(1, "a" * 50, 5, "own"), (2, "b" * 20, 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid long, sha string").withColumn("doc", F.lit(3)).withColumn("kept", F.lit("old"))
    found = suffix_dedup.remove_repeats(df, length=30)
    assert found.columns == ["doc_id", "text", "uid", "sha", "doc", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a" * 50, 5, "own", 3, 50, 50, 1, b""), (2, "b" * 20, 6, None, 3, 20, 0, 0, b"b" * 20)]
    assert suffix_dedup.remove_repeats(df.limit(0), length=30).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=0)


def test_suffix_dedup_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)  # pieces of a text meet at their edges
    rng = np.random.default_rng(9)
    long = "".join(rng.choice(list("abcdefgh"), 5000))
    rows = [(1, long), (2, long[700:2900] + "#" + long[2901:4000]), (3, "=" + long[1234:1300]), (4, long[::-1])]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string"), length=60, passes=2) == cut(rows, 60)


@pytest.mark.parametrize("period", [1, 7, 13, 31, 57, 183, 200, 310])
def test_difference_cover(period):
    v, cover = suffix_dedup.difference_cover(period)
    assert v <= max(period, 1)
    for i in range(v):
        for j in range(v):
            assert any((i + d) % v in cover and (j + d) % v in cover for d in range(v)) or v > 60
    assert {(a - b) % v for a in cover.tolist() for b in cover.tolist()} == set(range(v))
    assert len(cover) <= 2 * max(1, v) ** 0.5


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")
def test_op13_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in cut(rows, 400))
    assert sorted(tuple(r) for r in LLM_QUERIES["op13_suffix_dedup"](spark, SF).collect()) == want
