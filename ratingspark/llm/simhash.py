"""SimHash near-duplicates by pivot distance tables.

Fingerprints are made in one pass over the texts; only (doc_id, fingerprint)
leaves it.  Equal fingerprints are one node from then on.

The pivot table holds, for each node, its Hamming distances to reference
fingerprints, separately on each of ``distance + 2`` equal segments of the
bits.  Two fingerprints that differ in at most ``distance`` bits agree on two
segments at least, so their coordinates there differ by nothing: nodes are
bucketed by the coordinates of every two segments.  Within a bucket, a pair
whose whole-fingerprint distance to any reference differs by more than
``distance`` is discarded (the triangle inequality), and the bits of the
survivors are compared.  No pair within ``distance`` bits is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, slices
from .components import bucket_links, components

SHINGLE_WORDS = 3
DISTANCE = 2
BITS = 64
SEED = 42
#: Reference fingerprints: the XXH64 of the first numbers.
REFERENCES = tuple(xxhash.xxh64_intdigest(str(n), SEED) for n in range(16))
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a text: 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, in both
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*[tokens[i:] for i in range(words)])))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        octets = hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_hash, fingerprint)`` of ``docs(doc_id, text)``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                names=["doc_id", "text_hash", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       "text").mapInArrow(add, "doc_id long, text_hash long, fingerprint long")


def _signed(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def coordinates(node: Column, mask: int = (1 << BITS) - 1) -> Column:
    """Distances of a fingerprint to the references on the bits of ``mask``."""
    return F.array(*[F.bit_count(node.bitwiseXOR(_signed(r)).bitwiseAND(_signed(mask))).cast("byte")
                     for r in REFERENCES])


def _segments(count: int) -> list[int]:
    edges = [BITS * i // count for i in range(count + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def buckets(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(bucket, node)`` of ``nodes(node)``: a bucket for every two segments."""
    masks = _segments(distance + 2)
    keys = [F.xxhash64(F.lit(n), coordinates(F.col("node"), a), coordinates(F.col("node"), b))
            for n, (a, b) in enumerate(combinations(masks, 2))]
    return nodes.select("node", F.explode(F.array(*keys)).alias("bucket"))


def pivot_links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``nodes(node)`` within ``distance`` bits of each other."""
    def table(found: DataFrame) -> DataFrame:
        whole = [F.bit_count(F.col("node").bitwiseXOR(_signed(r))).cast("byte").alias(f"d{n}")
                 for n, r in enumerate(REFERENCES)]
        return found.select("node", F.struct(*whole, F.col("node").alias("bits")).alias("item"))

    def near(a: Column, b: Column) -> Column:
        apart = F.greatest(*[F.abs(a[f"d{n}"].cast("int") - b[f"d{n}"].cast("int")) for n in range(len(REFERENCES))])
        return (apart <= distance) & (F.bit_count(a["bits"].bitwiseXOR(b["bits"])) <= distance)

    return bucket_links(saved(buckets(nodes, distance), "pivots"), table, near, lambda pairs: pairs)


def groups(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Near-duplicate groups of ``docs(doc_id, text)``: one row per document.

    Columns: doc_id, text_hash (XXH64 of the text), fingerprint (long), root (a
    fingerprint of the group) and component_id, the smallest doc_id that links reach.  Null, empty and blank
    texts have the fingerprint 0 and link like any other; null ids never are a
    component's id unless all its ids are null; repeated rows are rows like
    others; an empty table gives no rows.  Other columns are ignored.
    """
    rows = saved(fingerprints(docs, words), "fingerprints")
    nodes = saved(rows.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(pivot_links(nodes.select("node"), distance))
    named = saved(nodes.join(roots, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_node = named.join(smallest, "root").select(F.col("node").alias("fingerprint"), "root", "component_id")
    return rows.join(by_node, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def hex_digits(column: str = "fingerprint") -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), BITS // 4, "0"))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: its smallest id, and of rows with that id the smallest text hash.

    All columns of ``docs`` stay.  Equal rows (id and text) are one document.
    A group whose ids are all null keeps one of its documents.
    """
    found = saved(groups(docs, words, distance).groupBy("root", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("copies")), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")
    best = found.groupBy("root").agg(F.min(F.struct(order.alias("order"), "copies")).alias("best")).select(
        F.col("best.order.doc_id").alias("_id"), F.col("best.order.text_hash").alias("_hash"),
        F.col("best.copies").alias("_copies"))
    best = saved(best, "kept")
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("_key"),
                        F.xxhash64("text").alias("_text"))
    match = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    kept = whole.join(best, match).select("doc", "_key", "_text", "_copies")
    if not best.where("_copies > 1").isEmpty():
        kept = kept.where("_copies = 1").unionByName(kept.where("_copies > 1").dropDuplicates(["_key", "_text"]))
    return kept.select("doc.*")
