"""Every registered query of the subpackage on small tables, against SQL or brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from ratingspark.llm.oracle import LLM_ORACLE
from ratingspark.llm.queries import LLM_QUERIES, VOCABULARY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name, sf=SF):
    return [r.asDict() for r in LLM_QUERIES[name](spark, sf).collect()]


def unite(nodes, links):
    """Smallest node of each component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_names():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    expected = con.sql(LLM_ORACLE[name])
    got = LLM_QUERIES[name](spark, SF)
    columns = sorted(expected.columns)
    assert columns == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(expected.select(*columns).fetchall())


@pytest.fixture(scope="module")
def encoded(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t, *_ in docs}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_round_trip(spark, docs, encoded):
    start, expected = 0, []
    for d, *_ in docs:
        expected.append(dict(doc_id=d, start=start, n_tokens=len(encoded[d]), ids_crc32=crc(encoded[d])))
        start += len(encoded[d])
    assert sorted(rows(spark, "op1_token_files"), key=lambda r: r["start"]) == expected


def test_op7_pieces_cover_all_ids_and_windows_hold(spark, encoded):
    pieces = defaultdict(list)
    windows = defaultdict(list)
    for r in rows(spark, "op7_packing"):
        ids = encoded[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == crc(ids[r["start"]:r["start"] + r["length"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts, total in ((pieces, {d: len(x) for d, x in encoded.items()}), (windows, None)):
        for key, spans in parts.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at and length > 0
                at += length
            assert at == total[key] if total else at <= 2048
    tokens = sum(len(x) for x in encoded.values())
    assert len(windows) <= math.ceil(tokens / 2048) + 2


def test_op2_brute_force(spark, docs):
    prints = {}
    for d, text, *_ in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    component = unite(ids, links)
    expected = {d: (f"{prints[d]:016x}", component[d]) for d in ids}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op2_simhash")}
    assert got == expected


def test_op3_brute_force(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    table = sorted(table)
    vectors = np.array([r[1] for r in table], np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & ~np.eye(len(table), dtype=bool)
    label = np.array([-1 if r[2] is None else r[2] for r in table])
    near &= (label[:, None] == label[None, :]) & (label >= 0)[:, None]
    ids = [r[0] for r in table]
    component = unite(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))])
    expected = {v: (int(n), component[v], component[v] == v) for v, n in zip(ids, near.sum(axis=1))}
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows(spark, "op3_embeddings")}
    assert got == expected


def test_op4_brute_force(spark, docs):
    def shingles(line):
        return frozenset(m[1] for m in re.finditer(r"(?=(.{1,16}))[^ ]{1,16} ?", line))

    where = [(d, n, re.sub(r"\s+", " ", line.lower()).strip()) for d, text, *_ in docs
             for n, line in enumerate((text or "").split("\n"))]
    where = [w for w in where if w[2]]
    sets = {line: shingles(line) for *_, line in where}
    by_shingle = defaultdict(set)
    for line, s in sets.items():
        for x in s:
            by_shingle[x].add(line)
    links = set()
    for line, s in sets.items():
        met = Counter(other for x in s for other in by_shingle[x])
        links |= {(line, o) for o, both in met.items()
                  if o != line and both >= 0.8 * (len(s) + len(sets[o]) - both) - 1e-9}
    root = unite(list(sets), links)
    groups = defaultdict(set)
    for d, n, line in where:
        groups[root[line]].add((d, n))
    got = defaultdict(set)
    found = rows(spark, "op4_lines")
    for r in found:
        got[r["component_id"]].add((r["doc_id"], r["line_no"]))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))
    assert {(r["doc_id"], r["line_no"]) for r in found if r["kept"]} == {min(g) for g in groups.values()}


def test_op5_held_out_accuracy(spark):
    larger = SF.replace("0.001", "0.01")
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{larger}/documents.parquet'").fetchall())
    found = rows(spark, "op5_language", larger)
    assert len(found) == len(lang)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in found if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def base_spans(text):
    spans = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[1]) >= 6:
            spans.append((m.start(), 0, "assign", m.end()))
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_op6_base_spans(spark, docs):
    texts = {d: t or "" for d, t, *_ in docs}
    for r in rows(spark, "op6_secrets"):
        spans = base_spans(texts[r["doc_id"]])
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        kinds = Counter(kind for _, _, kind, _ in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert {x for x in joined.split(",") if x} <= set(r["spans"].split(","))


def test_op9_edited_texts_and_likeness(spark, docs):
    order = sorted(docs, key=lambda r: -r[0])
    following = {r[0]: order[(i + 1) % len(order)] for i, r in enumerate(order)}
    found = {r["doc_id"]: r for r in rows(spark, "op9_spotsigs")}
    assert len(found) == len(docs)

    def spots(fingerprint):
        return {fingerprint[i:i + 8] for i in range(0, len(fingerprint), 8)}

    def likeness(a, b):
        return len(spots(a) & spots(b)) / len(spots(a) | spots(b))

    by_text = {}
    for d, text, *_ in docs:
        r, after = found[d], following[d]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[1][:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert r["near_edited"] == pytest.approx(likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(likeness(r["fingerprint"], found[after[0]]["fingerprint"]))
    ids = sorted(found)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if likeness(found[a]["fingerprint"], found[b]["fingerprint"]) >= 0.8 - 1e-9]
    component = unite(ids, links)
    assert {d: r["component_id"] for d, r in found.items()} == component


def test_op10_held_out_roles(spark):
    larger = SF.replace("0.001", "0.01")
    table = duckdb.sql(f"SELECT conv_id, turn, role FROM '{larger}/conversations.parquet'").fetchall()
    role = {(c, t): r for c, t, r in table}
    found = rows(spark, "op10_chat", larger)
    assert sorted((r["conv_id"], r["turn"]) for r in found) == sorted(role)
    held = [r for r in found if r["held_out"]]
    assert sum(r["role_pred"] == role[r["conv_id"], r["turn"]] for r in held) >= 0.9 * len(held)
