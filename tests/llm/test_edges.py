"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ratingspark.llm import (chat, embeddings, langid, lines, mixing, packing, secrets, simhash, spotsigs,
                             token_files, tokens)
from ratingspark.llm.common import shared_folder
from ratingspark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORDS = [a + b for a in ("ka", "mo", "ri", "tul", "ves", "zor") for b in ("ban", "del", "fip", "gon", "hus", "jit")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


ROWS = [
    (1, "The cat and the dog of the house", "en", "a", 0), (1, "The cat and the dog of the house", "en", "a", 0),
    (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t ", "de", "b", 5), (None, prose(1, 30), "en", "c", 9),
    (None, None, None, None, None), (5, prose(2, 12_000) + "\n" + prose(3, 40), "fr", "a", 7),
    (6, "é ß İ ſ   ’s <|endoftext|> \x1c x", "es", "c", 1), (7, prose(4, 20), "en", None, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHES = ("bucket", "node", "key", "line", "size", "target", "taken", "lang_pred", "score", "rejected", "fingerprint",
           "component_id", "_key", "_text", "_id", "doc", "copies", "part", "guest", "bands")


def clashing(docs):
    from pyspark.sql import functions as F
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def test_token_files(spark, docs, empty):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected, at = [], 0
    for d, t in sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        expected.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    for given in (docs, clashing(docs)):
        folder = shared_folder(spark, "test")
        token_files.write_token_files(given, folder, VOCABULARY, shards=3)
        got = [tuple(r) for r in token_files.read_token_files(spark, folder).collect()]
        assert sorted(got, key=lambda r: r[1]) == expected
    folder = shared_folder(spark, "test")
    token_files.write_token_files(empty, folder, VOCABULARY, shards=3)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_word_lookup_equals_whole_texts():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [r[1] or "" for r in ROWS] + ["don't we'll it's A.B,c!? 12ab", "naïve café Ünï", "a b c\x85d", "Σας ΟΔΟΣ"]
    for memo in (3, 1000):
        got = tokens.WordEncoder(VOCABULARY, memo).documents(texts)
        assert [x[:-1].tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_simhash(spark, docs, empty):
    for given in (docs, clashing(docs)):
        rows = simhash.groups(given).collect()
        assert len(rows) == len(ROWS)
        group = {r.doc_id: r.component_id for r in rows}
        assert group[2] == group[3] == group[4] == 2  # no words: fingerprint 0
        assert group[1] == 1 and group[7] == 7
    kept = simhash.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 5, 6, 7] and ids.count(None) == 1
    assert simhash.groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_finds_all_pairs_of_a_dense_group(spark):
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(8):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "node long")
    links = simhash.pivot_links(frame)
    roots = {r.node: r.root for r in components(links).collect()}
    groups = {}
    for p in signed:
        groups.setdefault(roots.get(p, p), set()).add(p)
    brute = {p: p for p in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 and brute[a] > brute[b]:
                    brute[a], changed = brute[b], True
    expected = {}
    for p, r in brute.items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7), (1, 0)], "a long, b long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[1000] == roots[1001] != roots[0]
    assert components(links.limit(0)).count() == 0


def brute_vectors(rows):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.asarray(v, np.float32).astype(float)
        return v / np.linalg.norm(v)
    units = [unit(v) for _, v, _ in rows]
    near = {i: [j for j in range(len(rows)) if i != j and units[i] is not None and units[j] is not None
                and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
                and units[i] @ units[j] >= 0.93] for i in range(len(rows))}
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((vec_id, len(near[i]), first, vec_id == first))
    return sorted(out, key=str)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [float("nan"), 1.0, 1.0], 1),
            (6, [float("inf"), 1.0, 1.0], 1), (7, [1.0, 0.0, 0.0], None), (8, [1.0, 0.0, 0.0], 2), (8, [2.0, 0.0, 0.0], 2),
            (9, [1.0, 0.0], 2), (None, [1.0, 0.0, 0.0], 2), (10, [-1.0, 0.0, 0.0], 2), (11, [1e30, 1e30, 0.0], 3),
            (12, [1e-30, 1e-30, 0.0], 3)]
    near = rng.normal(size=(6, 3))
    rows += [(100 + i, (near[i % 6] + rng.normal(scale=0.15, size=3)).tolist(), int(i % 2)) for i in range(90)]
    schema = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame(rows, schema)
    expected = brute_vectors(rows)
    for sizes in (dict(), dict(cell_rows=8, block_rows=7)):  # one cell, and many cells of many blocks
        got = embeddings.near_duplicates(frame, **sizes).collect()
        assert sorted((tuple(r) for r in got), key=str) == expected
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_lines(spark, docs, empty):
    first, near = prose(8, 40), prose(8, 39) + " altered"
    rows = [(1, f"{first}\nshort\n\nother {prose(9, 30)}", "x"), (2, f"{near}\nSHORT\n  \nlast", "x"),
            (2, f"{near}\nSHORT\n  \nlast", "x"), (3, None, "x"), (4, "", "x"), (None, "short\nnew", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = lines.drop_repeated(frame)
    assert got.columns == frame.columns
    expected = [(1, rows[0][1], "x"), (2, "  \nlast", "x"), (2, "  \nlast", "x"), (3, None, "x"), (4, "", "x"), (None, "new", "x")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    assert lines.drop_repeated(clashing(docs)).count() == len(ROWS)
    assert lines.repeated(empty).count() == 0 and lines.drop_repeated(empty).count() == 0


def test_near_lines_of_one_group_are_found_through_each_other(spark):
    """A chain of edits: neighbours are similar, the ends are not."""
    words = prose(21, 60).split()
    texts = []
    for i in range(0, 40, 4):
        words[i] = f"edit{i}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lines.repeated(frame).collect()
    assert len({r.component_id for r in found}) == 1 and [r.doc_id for r in found if r.kept] == [0]


def test_near_lines_without_spaces(spark):
    """Edits near the front of unspaced lines, against a brute force over every character."""
    rng = random.Random(31)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(400))
    plane = "".join(chr(rng.randrange(0x20000, 0x2A000)) for _ in range(120))
    csv = ",".join(f"field{rng.randrange(10**6)}" for _ in range(75))
    code = '{"id":' + ",".join(f'"{w}":{i}' for i, w in enumerate(prose(33, 60).split())) + "}"
    log = f"2024-01-02T03:04:05.678901Z get https://example.org/{'/'.join(prose(34, 30).split())}?q=1 took 12 ms"
    unlike = csv[:300] + ",".join(f"other{rng.randrange(10**6)}" for _ in range(45))
    texts = [chinese, "x" + chinese, plane, plane[:5] + plane[6:], csv, csv[0] + csv[3:], code, code[:3] + "k" + code[3:],
             log, log.replace("example", "a.example"), unlike, "q" * 17, "q" * 30, "short run"]

    def every(line):
        return {line[i:i + 16] for i in range(len(line) - 15)}

    sets = [every(t) for t in texts]
    near = {(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j]
            and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert near == {(1, 0), (3, 2), (5, 4), (7, 6), (9, 8), (12, 11)}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r.doc_id: r.component_id for r in lines.repeated(frame).collect()}
    assert {(i, j) for i in root for j in root if j < i and root[i] == root[j]} == near


def test_language(spark, docs, empty):
    samples = langid.learn(docs)
    got = langid.predict(clashing(docs), samples)
    assert got.columns == [c for c in clashing(docs).columns if c not in ("lang_pred", "score", "rejected")] + [
        "lang_pred", "score", "rejected"]
    rows = got.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        blank = not any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == blank and 0 <= r.score <= 1 and (r.rejected or not blank)
    assert langid.learn(empty) == {} and langid.predict(empty, {}).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    held = langid.predict(docs.select("doc_id", "text"), {"only": ["x"]})
    assert {r.lang_pred for r in held.collect()} == {"und", "only"}


def test_secrets(spark, empty):
    rng = random.Random(11)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = "".join(rng.choice(base62) for _ in range(40)) + "7aZ"
    rows = [(1, f"😀 x {key} y"), (2, "token: token: abcdefgh"), (3, None), (4, ""),
            (5, "Password = 'hunter22' API-KEY apikey=short api_KEY:longer1 AKIA" + "A" * 15 + " AKIA" + "B" * 16),
            (6, "f" * 23 + " " + "0" * 24 + "g"), (7, "a1" * 30), (None, "secret=abcdef"), (8, "internationalization" * 3)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", secrets.joined("base").alias("base"), secrets.joined("spans").alias("spans")).collect()}
    assert got[1].base == "" and got[1].spans == "random:4:47"
    assert got[2].base == "" and got[3].spans == "" and got[4].spans == ""
    assert got[5].base == "assign:0:20,assign:43:58,access:79:99"
    assert got[6].base == "hex:24:48"
    assert got[7].spans == got[7].base == "hex:0:60" and got[8].spans == ""
    assert got[None].base == "assign:0:13"
    assert secrets.scan(empty).count() == 0


def test_secrets_of_upper_case_and_behind_paths(spark):
    rng = random.Random(17)
    upper = "".join(rng.choice("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(40)) + "Z0189"
    base62 = secrets.ENCODINGS[4][2]
    key = "".join(rng.choice(base62) for _ in range(40)) + "7aZ"
    rows = [(1, f"key {upper}"), (2, f"see /my-app/{key} now"), (3, f"é a_b+c/{key}-x_{upper}=="), (4, "/some-path/of_plain/words-only1"),
            (5, "AB01" * 12), (6, f"/my-app/{key[:19]}")]
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", secrets.joined("spans").alias("spans")).collect()}
    assert got == {1: "random:4:49", 2: "random:12:55", 3: "random:8:51,random:54:99", 4: "", 5: "", 6: ""}


def test_random_strings_are_told_from_regular_ones(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    chars = secrets.ENCODINGS[4][2]
    good = ["".join(rng.choice(chars) for _ in range(48)) for _ in range(200)]
    bad = ["".join(rng.choice("abAB01") for _ in range(48)) for _ in range(200)]
    frame = spark.createDataFrame([(s, s in set(good)) for s in good + bad], "s string, good boolean")
    symbols = F.transform(F.filter(F.split("s", ""), lambda c: c != ""), lambda c: F.instr(F.lit(chars), c) - 1)
    rows = frame.select("good", secrets.p_value(symbols, F.lit(len(chars))).alias("p")).collect()
    assert sum(r.p < 0.01 for r in rows if r.good) <= 8
    assert all(r.p < 1e-3 for r in rows if not r.good)


def test_packing(spark, docs, empty):
    large = (1 << 62) + 1  # ids keep all their digits beside nulls
    given = clashing(docs.selectExpr(f"if(doc_id = 7, {large}, doc_id) AS doc_id", "text", "source"))
    pieces = packing.pack_documents(given, VOCABULARY).collect()
    assert {r.doc_id for r in pieces} == {1, 2, 3, 4, 5, 6, large, None}
    lengths = [len(x) for x in tokens.WordEncoder(VOCABULARY).documents([r[1] for r in ROWS])]
    assert sum(r.length for r in pieces) == sum(lengths)
    windows = {}
    for r in pieces:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack_documents(empty, VOCABULARY).count() == 0


def test_differencing():
    rng = random.Random(4)
    for _ in range(20):
        sizes = [rng.randint(1, 512) for _ in range(rng.randint(1, 120))]
        windows = packing.pack(sizes)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in w) for w in windows) <= packing.CAPACITY
        assert len(windows) <= -(-sum(sizes) // packing.CAPACITY) + 1
    items, sums = packing.difference([8, 7, 6, 5, 4], 2)  # the textbook case of the method
    assert sorted(sums) == [14, 16] and sorted(i for w in items for i in w) == [0, 1, 2, 3, 4]


def test_mixing(spark, docs, empty):
    rows = mixing.shares(clashing(docs)).collect()
    assert len(rows) == len(ROWS)
    by_source = {}
    for r in rows:
        text = {(x[0], x[3]): x[1] for x in ROWS}[r.doc_id, r.source] or ""
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        assert r.size == size and 0 <= r.taken <= 3 * r.size
        by_source.setdefault(r.source, []).append(r)
    assert sum(g[0].target for g in by_source.values()) == pytest.approx(sum(r.size for r in rows))
    for group in by_source.values():
        assert abs(sum(r.taken for r in group) - group[0].target) <= len(group)
    assert mixing.shares(empty).count() == 0
    own = ("size", "target", "rest", "source_size", "epochs", "taken", "_key", "_size", "_source", "_copy", "doc", "code")
    marked = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("source"), F.lit("?"))) for c in own})
    kept = mixing.mixed_documents(marked)
    assert kept.columns == marked.columns and kept.schema == marked.schema
    assert all(r[c] == f"{c} of {r['source'] or '?'}" for r in kept.collect() for c in own)
    assert sorted(map(str, kept.select("doc_id", "text", "source").collect())) == sorted(
        map(str, mixing.mixed_documents(docs).select("doc_id", "text", "source").collect()))
    mixed = mixing.materialize(mixing.mix(docs)).collect()
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed) == sum(r.taken for r in rows)


def test_first_words(spark):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([("  a b\n c ", 2), ("a b c", 1), ("a", 1)], "t string, n int")
    assert [r[0] for r in frame.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == ["  a b\n ", "a ", "a"]


def test_spotsigs(spark, docs, empty):
    rows = spotsigs.fingerprints(clashing(docs)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint
    one = spotsigs.fingerprints(docs.where("doc_id = 7")).first()
    assert one.near_next == 1.0
    assert spotsigs.fingerprints(empty).count() == 0


def test_spotsigs_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 7)
    texts = [(i * 3, f"the {prose(i, 6)} of a {prose(i + 500, 9)}") for i in range(100)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.edited_sha256 for r in spotsigs.fingerprints(frame).collect()}
    import hashlib
    order = texts[::-1]
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        assert found[d] == hashlib.sha256((t[:len(t) - len(t) // 2] + after[:len(t) // 2]).encode()).hexdigest()


def test_spotsigs_near_duplicates(spark, empty):
    base = " ".join(f"the {a} {b}" for a, b in zip(prose(1, 60).split(), prose(2, 60).split()))
    rows = [(3, base), (5, base + " the end of it all"), (9, prose(7, 80)), (4, base), (None, None), (8, "")]
    got = {r.doc_id: r.component_id for r in spotsigs.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3: 3, 5: 3, 4: 3, 9: 9, None: 8, 8: 8}
    assert spotsigs.near_duplicates(empty).count() == 0


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_markers_and_rendering(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", prose(c * 10 + t, 8 if t % 2 == 0 else 60))
            for c in range(60) for t in range(4)]
    counts = chat.learn(spark.createDataFrame(rows, CHAT))
    new = [(1000, 0, None, "User: hello there?\nAssistant: " + prose(5, 50)), (1001, 0, None, None), (None, None, None, ""),
           (1002, 0, "x", "Human: " + prose(6, 8)), (1002, 1, "x", prose(7, 60)), (1002, 1, "x", prose(7, 60)),
           ((1 << 62) + 1, 0, None, "x")]
    got = chat.format_chat(spark.createDataFrame(new, CHAT), counts).collect()
    assert len(got) == len(new)
    assert sorted(r.conv_id for r in got if r.conv_id is not None)[-1] == (1 << 62) + 1
    first = next(r for r in got if r.conv_id == 1000)
    assert first.n_turns == 2 and first.role_pred == "user"
    assert first.rendered.startswith("<|im_start|>user\nhello there?<|im_end|>\n<|im_start|>assistant\n")
    assert {r.role_pred for r in got if r.conv_id == 1002 and r.turn == 0} == {"user"}
    blank = spark.createDataFrame([], CHAT)
    assert chat.learn(blank) == {} and chat.format_chat(blank, {}).count() == 0


def test_chat_counts_do_not_depend_on_blocks(spark, monkeypatch):
    roles = ("user", "assistant", "user", "other", "assistant")
    rows = [(c, 300 * c + 2 * t, roles[(t + c) % 5], prose(c * 100 + t, 5) + "\nmore" * (t % 2))
            for c in range(1, 8) for t in range(30)]
    rows += [(c, None, "system", "be brief") for c in (2, 3)]
    frame = spark.createDataFrame(rows, CHAT).repartition(3)
    found = []
    for block in (10**6, 256, 3):
        monkeypatch.setattr(chat, "BLOCK", block)
        found.append(chat.learn(frame))
    learned = [c for c in range(1, 8) if zlib.crc32(str(c).encode()) % chat.FOLDS]
    first = [c for c in learned if c in (2, 3) or roles[c % 5] in chat.ROLES]
    for counts in found:
        assert sum(n for (kind, *_), n in counts.items() if kind == "first") == len(first)
        assert counts == found[1]
    steps = 0
    for c in learned:
        last = None
        for _, _, role, text in sorted((r for r in rows if r[0] == c), key=lambda r: -1 if r[1] is None else r[1]):
            known = role in chat.ROLES
            steps += (text.count("\n") + (last is not None)) if known else 0
            last = role if known else None
    assert sum(n for (kind, *_), n in found[1].items() if kind == "step") == steps


def test_chat_blocks_find_the_path_of_one_pass(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    rng = random.Random(9)
    rows = [(c, t, ("user", "assistant")[(t + c) % 2], prose(c * 100 + t, rng.choice((4, 30, 70)))) for c in (1, 2) for t in range(40)]
    frame = spark.createDataFrame(rows, CHAT)
    model = chat.Model(counts := {("step", 0, 2): 3.0, ("length", 2, 4): 5.0, ("length", 4, 6): 5.0})
    got = {(r.conv_id, r.turn): r.role_pred for r in chat.format_chat(frame, counts).collect()}
    for c in (1, 2):
        texts = [r[3] for r in rows if r[0] == c]
        scores = model.scores([x for t in texts for x in chat.observe(t)])

        def score(path):  # equally likely paths are equally good
            steps = sum(model.step[a, b] for a, b in zip(path, path[1:]))
            return model.first[path[0]] + steps + sum(s[p] for s, p in zip(scores, path))

        path = chat.best_path(model, scores, -1, None)
        assert score([2 * chat.ROLES.index(got[c, t]) for t in range(40)]) == pytest.approx(score(path))


def test_pipeline_stages(spark, docs, empty):
    """Each stage on awkward rows and on no rows; columns stay until the last."""
    for given in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, "")
            if name != "packing":
                assert out.columns == given.columns, name
            out.count()


def test_pipeline_by_hand(spark):
    """Two sources, a foreign line, an exact and a near copy: what each stage decides."""
    english = [f"the {prose(i, 12)} and of the\n{prose(i + 300, 25)}" for i in range(30)]
    rows = [(i, t, "en", "a" if i % 2 else "b", len(t)) for i, t in enumerate(english)]
    rows += [(90, english[0], "en", "a", 1), (91, english[1] + "\nadded line of its own", "en", "b", 1), (92, "12 34", "en", "a", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language_id"](spark, docs, "")
    assert 92 not in {r.doc_id for r in told.collect()}
    deduped = {r.doc_id: r for r in stages["line_dedup"](spark, docs, "").collect()}
    assert deduped[90].text == "" and deduped[90].n_chars == 0 and deduped[91].text == "added line of its own"
    assert all(deduped[i].text == english[i] for i in range(30))
    single = {r.doc_id for r in stages["near_dedup"](spark, docs, "").collect()}
    assert 90 not in single and set(range(30)) <= single
    mixed = stages["mixing"](spark, docs, "").collect()
    words = sum(len(r[1].split()) for r in rows)
    assert abs(sum(len(r.text.split()) for r in mixed) - words) <= 4


def test_signatures_of_long_runs_of_common_words(spark):
    rows = [(1, "the " * 200_000), (2, "the " * 100_000 + "cat " + "of " * 100_000), (3, "the cat " + "of " * 100_000 + "dog"), (4, "the cat dog")]
    found = spotsigs.with_signatures(spark.createDataFrame(rows, "doc_id long, text string"), "text", "item")
    items = {r.doc_id: r["item"] for r in found.select("doc_id", "item").collect()}
    assert items[3] == items[4] and len(items[1]) == len(items[2]) == 1


def test_set_buckets_hold_all_links_and_few_others(spark):
    draw = random.Random(5)
    sets = set()
    for n in (1, 2, 4, 5, 6, 8, 9, 10, 15, 30, 60, 150) * 4:
        base = {draw.randrange(-1 << 31, 1 << 31) for _ in range(n)}
        for _ in range(3):
            lost = set(draw.sample(sorted(base), n // 9))
            sets.add(tuple(sorted(base - lost | {draw.randrange(-1 << 31, 1 << 31) for _ in range(draw.randint(0, n // 9 + 1))})))
    for n in (5, 6, 8, 14, 40):  # hashes of one part, so that the others are empty
        sets |= {tuple(sorted({720720 * draw.randrange(1, 2 * n) for _ in range(n)})) for _ in range(6)}
    common = [7 * n for n in range(50)]  # a hash that unlike sets share is no bucket
    sets |= {tuple(sorted({common[n], *(draw.randrange(-1 << 31, 1 << 31) for _ in range(40))})) for n in range(50) for _ in range(4)}
    sets = sorted(sets)
    frame = spark.createDataFrame([(n, list(s)) for n, s in enumerate(sets)], "node long, item array<int>")
    buckets = [set() for _ in sets]
    for r in spotsigs.set_buckets(frame).collect():
        buckets[r.node].add(r.bucket)
    links = others = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = set(sets[i]), set(sets[j])
        if len(a & b) >= 0.8 * len(a | b) - 1e-9:
            links += 1
            assert buckets[i] & buckets[j]
        elif len(a & b) == 1:
            others += bool(buckets[i] & buckets[j])
    assert links > 20 and others < 10


def test_longer_runs_and_space_as_by_regex(spark):
    texts = ["a b", "x" * 16, "x" * 17, "a " + "y" * 17, "é" * 16 + " b", "é" * 17, "😀" * 17, " " + "z" * 16, "z" * 16 + " ",
             "a\x85" + "b" * 15, " " * 17, "a  b\t c", "\x0b q \f", " \t ", "a\r", "ΑΣ  Β", " a", "no 　 space"]
    frame = spark.createDataFrame([(t,) for t in texts], "line string")
    lines_ = frame.select("line", lines.normal(F.col("line")).alias("low"),
                          F.trim(F.regexp_replace(F.lower("line"), r"\s+", " ")).alias("by_regex")).where("by_regex <> ''")
    found = lines_.withColumn("found", lines.blocks(F.col("low"))).select(
        "line", "low", "by_regex", lines.has_longer_run(F.col("low"), F.col("found")).alias("run"),
        F.col("low").rlike("(?:^| )[^ ]{17}").alias("run_by_regex")).collect()
    assert all(r.low == r.by_regex and r.run == r.run_by_regex for r in found)
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in lines.lines(docs).collect()} == {n for n, t in enumerate(texts) if re.search(r"[^ \t\x0b\f\r]", t)}


def test_lines_that_differ_behind_a_separator(spark):
    """Blocks hold all characters of a line: those behind a next line, line or paragraph separator as well."""
    texts = [f"ab{x}{end}" for x in "\x85\u2028\u2029" for end in ("first", "second")] + ["\u2028x", "\u2028y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.found for r in frame.select("doc_id", lines.blocks(F.col("text")).alias("found")).sort("doc_id").collect()] == [[t] for t in texts]
    found = lines.repeated(frame).collect()
    assert len(found) == len({r.component_id for r in found}) == len(texts) and all(r.kept for r in found)
    assert sorted(r.text for r in lines.drop_repeated(frame).collect()) == sorted(texts)


def test_encoder_gives_unused_memory_back(monkeypatch):
    given = []

    class Pool:
        def release_unused(self):
            given.append(True)

    encoder = tokens.encoder(VOCABULARY)
    monkeypatch.setattr(tokens.pa, "default_memory_pool", Pool)
    assert [len(x) > 1 for x in encoder.documents(["a word", None])] == [True, False] and given


def test_language_stage_sends_each_text_once(spark, monkeypatch):
    """In small batches, as the field of a struct, with the result of a plain column."""
    rows = [(n, f"{text} {n}", lang, "old", "x") for n, (text, lang) in enumerate([
        ("the house and the garden are green and the river is wide", "en"),
        ("das Haus und der Garten sind gruen und der Fluss ist breit", "de")] * 30)] + [(90, None, None, None, "y"), (91, "12 34", "en", "z", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, source string")
    sent, batches, predict, write = [], [], langid.predict, DataFrameWriter.parquet

    def written(writer, *args, **options):
        batches.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return write(writer, *args, **options)

    monkeypatch.setattr(langid, "predict", lambda docs, *args, **options: sent.append(docs) or predict(docs, *args, **options))
    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    found = corpus_pipeline.identify_language(spark, frame, "")
    plain = predict(frame.withColumnRenamed("lang_pred", "given"), langid.learn(frame)).where("not rejected")
    assert found.columns == frame.columns and batches == ["1000"]
    assert sorted(found.collect()) == sorted(plain.select("doc_id", "text", "lang", F.col("given").alias("lang_pred"), "source").collect())
    assert 40 < found.count() < len(rows)
    assert sent[0].schema.simpleString().count("text:string") == 1
