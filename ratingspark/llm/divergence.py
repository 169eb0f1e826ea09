"""Source divergence audit by single-pass in-memory indexing.

One pass over the texts builds postings (term -> count and documents, by
language and source) in memory.  When a block's texts reach ``BLOCK_BYTES`` it
is spilled: one term-sorted run for each hash shard of the terms.  The runs
meet by shard, in the order of their first terms, and a heap merges them into
the frequencies of each term; only runs that overlap are open at a time.

The divergence of every pair of sources sums a term's share over all kept
terms, also over those that a source lacks.  Most of these sums need no pass
over pairs: with zero counts every term has a source's floor share, and one
source's own counts enter through a histogram of its shares.  What is left are
terms that both sources of a pair hold.  They are streamed once, and each adds
the correction between its real value and what the histograms assumed.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices, small

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Bytes of text that a block holds before it is spilled; entries of a row of a run; entries merged at a time.
BLOCK_BYTES = 8 << 20
RUN_ENTRIES = 512
MERGE_ENTRIES = 1 << 16
#: Pairs of shares that a task holds.
PAIRS = 1 << 20
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)

_POSTING = "lang string, term binary, source string, n long, docs long, lang_n long, first boolean"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a binary array of texts, and the row of each."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_LETTERS[data]))
    lists = pc.ascii_split_whitespace(plain)
    rows = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    terms = lists.flatten().cast(pa.large_binary())
    real = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(real), rows[real.to_numpy(zero_copy_only=False)]


class Block:
    """Postings of the documents since the last spill.

    The empty term counts documents, so that a group without terms is known.
    """

    def __init__(self) -> None:
        self.terms: list[pa.Array] = []
        self.rows: list[np.ndarray] = []
        self.group_of: list[int] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        terms, rows = terms_of(batch.column("text"))
        first = len(self.group_of)
        pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        self.group_of += [self.groups.setdefault(pair, len(self.groups)) for pair in pairs]
        empty = pa.array([b""] * batch.num_rows, pa.large_binary())
        self.terms += [terms, empty]
        self.rows += [rows + first, np.arange(first, len(self.group_of))]
        self.size += batch.nbytes

    def spill(self, shards: int) -> Iterator[pa.RecordBatch]:
        """Term-sorted runs by shard and language; the block is empty afterwards."""
        if not self.group_of:
            return
        coded = pa.chunked_array(self.terms).combine_chunks().dictionary_encode()
        group_of, rows, names = np.array(self.group_of), np.concatenate(self.rows), list(self.groups)
        words = coded.dictionary
        order = pc.sort_indices(words).to_numpy()
        words = words.take(pa.array(order))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term = place[coded.indices.to_numpy()]
        self.__init__()
        width = len(words)
        seen, counts = np.unique(rows * width + term, return_counts=True)  # a document and a term
        doc, term = seen // width, seen % width
        key, at, docs = np.unique(group_of[doc] * width + term, return_inverse=True, return_counts=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, at, counts)
        group, term = key // width, key % width
        n[term == 0] = 0  # the empty term comes first
        langs = sorted({lang for lang, _ in names})
        lang = np.array([langs.index(name) for name, _ in names])[group]
        shard = (np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, width) % shards)[term]
        order = np.lexsort((group, term, lang, shard))
        shard, lang, term, group, n, docs = (x[order] for x in (shard, lang, term, group, n, docs))
        new = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (lang[1:] != lang[:-1])]))
        ends = np.append(new[1:], len(order))
        starts = np.concatenate([np.arange(a, b, RUN_ENTRIES) for a, b in zip(new, ends)])
        offsets = pa.array(np.append(starts, len(order)).astype(np.int32))
        sources = pa.array([source for _, source in names], pa.string()).take(pa.array(group))
        terms = words.cast(pa.binary()).take(pa.array(term))
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (terms, sources, pa.array(n), pa.array(docs))]
        run = pa.RecordBatch.from_arrays([
            pa.array(shard[starts].astype(np.int32)), pa.array(langs, pa.string()).take(pa.array(lang[starts])),
            terms.take(pa.array(starts)), *lists], names=["shard", "lang", "first", "terms", "sources", "counts", "docs"])
        yield from slices([run], 64)


class Merge:
    """Heap of the open runs of one (shard, language), by the first term that is left of each."""

    def __init__(self, min_docs: int):
        self.heap: list[tuple] = []
        self.key, self.held, self.min_docs = None, 0, min_docs

    def push(self, key: tuple, number: int, run: pa.Table, first: bytes) -> Iterator[pa.RecordBatch]:
        """Opens a run; runs come in the order of (key, first)."""
        if key != self.key:
            yield from self.drain(None)
            self.key = key
        elif self.held >= MERGE_ENTRIES:
            yield from self.drain(first)
        heapq.heappush(self.heap, (first, number, run))
        self.held += run.num_rows

    def drain(self, limit: bytes | None) -> Iterator[pa.RecordBatch]:
        """Frequencies of the terms before ``limit``: no run that is still to come holds them."""
        done = []
        while self.heap and (limit is None or self.heap[0][0] < limit):
            _, number, run = heapq.heappop(self.heap)
            cut = run.num_rows if limit is None else bisect_left(run.column("term"), limit, key=lambda x: x.as_py())
            done.append(run.slice(0, cut))
            if cut < run.num_rows:
                rest = run.slice(cut)
                heapq.heappush(self.heap, (rest.column("term")[0].as_py(), number, rest))
        if done:
            yield from self._frequencies(pa.concat_tables(done))
        self.held = sum(run.num_rows for _, _, run in self.heap)

    def _frequencies(self, entries: pa.Table) -> Iterator[pa.RecordBatch]:
        sums = entries.group_by(["term", "source"]).aggregate([("n", "sum"), ("docs", "sum")]).sort_by("term")
        terms = sums.column("term").combine_chunks()
        code = terms.dictionary_encode().indices.to_numpy()
        start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        docs, total = (np.add.reduceat(sums.column(c).to_numpy(), start)[code] for c in ("docs_sum", "n_sum"))
        first = np.zeros(len(code), bool)
        first[start] = True
        kept = (docs >= self.min_docs) | (code == 0) & (terms[0].as_py() == b"")
        out = pa.RecordBatch.from_arrays([
            pa.array([self.key[1]] * len(code), pa.string()), terms, sums.column("source").combine_chunks(),
            sums.column("n_sum").combine_chunks(), pa.array(docs), pa.array(total), pa.array(first)],
            names=["lang", "term", "source", "n", "docs", "lang_n", "first"])
        yield out.filter(pa.array(kept))


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(lang, term, source, n, docs, lang_n, first)`` of ``docs(lang, source, text)``.

    Terms in at least ``min_docs`` documents of their language, with the
    language's documents and occurrences; ``first`` marks one row of a term.
    The empty term counts the documents of each group.
    """
    shards = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # parts of one size, dealt to tasks
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in slices(batches):
            block.add(batch)
            if block.size >= block_bytes:
                yield from block.spill(shards)
        yield from block.spill(shards)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, number = Merge(min_docs), 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, lang, first = (batch.column(c)[i].as_py() for c in ("shard", "lang", "first"))
                run = pa.table([batch.column(c)[i].values for c in ("terms", "sources", "counts", "docs")],
                               names=["term", "source", "n", "docs"])
                number += 1
                yield from runs.push((shard, lang), number, run, first)
        yield from runs.drain(None)

    runs = given.mapInArrow(invert, "shard int, lang string, first binary, terms array<binary>, sources array<string>, "
                                    "counts array<long>, docs array<long>")
    met = runs.repartition("shard").sortWithinPartitions("shard", "lang", "first")
    return saved(met.mapInArrow(merge, _POSTING), "frequencies")


def _share(n: str, total: str) -> Column:
    """p of a count, exact at any size (null in a language without kept terms)."""
    return F.expr(f"1 + (cast({SCALE} as decimal(38,0)) * ({n} + 1)) div nullif({total} + terms, 0)")


def _excess(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def group_sizes(found: DataFrame) -> DataFrame:
    """``(lang, source, code, total, terms, lang_total, floor)`` of every group; codes count a language's sources."""
    terms = found.where("first and length(term) > 0").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    known = totals.join(terms, "lang", "left").na.fill(0, ["terms"])
    return saved(known.select(
        "lang", "source", F.row_number().over(of_lang.orderBy("source")).alias("code"), "total", "terms",
        F.sum("total").over(of_lang).alias("lang_total"),
        F.coalesce(_share("0", "total"), F.lit(1)).alias("floor")), "groups")


def _excess_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Corrections:
    """Sums of corrections by ordered pair of one language's sources."""

    def __init__(self) -> None:
        self.parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, lang: str, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.setdefault(lang, []).append((keys, values))
        self.size += len(keys)
        if self.size >= 4 * PAIRS:
            self.parts = {lang: [self._sums(parts)] for lang, parts in self.parts.items()}
            self.size = sum(len(parts[0][0]) for parts in self.parts.values())
        if self.size >= 2 * PAIRS:  # more pairs than are to be held: they go out, and Spark sums them
            yield from self.rows()

    @staticmethod
    def _sums(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, np.concatenate([v for _, v in parts]))
        return keys, sums

    def rows(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.parts.items():
            keys, sums = self._sums(parts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(keys), pa.string()), pa.array((keys >> 32).astype(np.int32)),
                pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)], names=["lang", "a", "b", "value"])
        self.__init__()


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows (lang, term, code, p, floor) in the order of (lang, term); both sources of a pair hold the term."""
    out, held = Corrections(), None

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        term = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        code, p, low = (rows.column(c).to_numpy().astype(np.int64) for c in ("code", "p", "floor"))
        names, lang = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        i, step = np.arange(len(term) - 1), 1
        while True:  # rows of one term stand together: each meets the next, the one after it, and so on
            i = i[(i + step < len(term))]
            i = i[(term[i] == term[i + step]) & (lang[i] == lang[i + step])]
            if not len(i):
                return
            for x, y in ((i, i + step), (i + step, i)):
                value = (_excess_of(p[x], p[y]) - _excess_of(p[x], low[y]) - _excess_of(low[x], p[y]) + _excess_of(low[x], low[y]))
                for n, name in enumerate(names):
                    own = lang[i] == n
                    yield from out.add(name, (code[x] << 32 | code[y])[own], value[own])
            step += 1

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        last = rows.slice(rows.num_rows - 1)
        same = pc.and_(pc.equal(rows.column("lang"), last.column("lang")[0]), pc.equal(rows.column("term"), last.column("term")[0]))
        cut = rows.num_rows - int(pc.sum(same).as_py() or 0)  # the last term may go on in the next batch
        if cut:
            yield from pairs(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield from pairs(held)
    yield from out.rows()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(lang, source, text)``.

    Part ``pair``: the divergence of every ordered pair of a language's
    sources; part ``term``: the ``top_terms`` terms that a source holds above
    its language's share.  Null lang, source and text are empty; empty texts
    count as documents; ranks break ties by the item, repeated rows are
    documents of their own, long texts are read in pieces, other columns are
    not looked at.  A language without kept terms has pairs of value zero; an
    empty table gives no rows.
    """
    found = frequencies(docs, min_docs, block_bytes)
    sizes = group_sizes(found)
    given = F.broadcast(sizes) if small(sizes, 128) else sizes
    shares = saved(found.where("n > 0").withColumn("term", F.col("term").cast("string")).join(given, ["lang", "source"]).select(
        "lang", "source", "code", "term", "floor", _share("n", "total").alias("p"),
        _share("lang_n", "lang_total").alias("q")), "shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          _excess("p", "q").alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    by_term = shares.select("lang", "term", "code", "p", "floor").repartition("lang", "term").sortWithinPartitions("lang", "term")
    exact = by_term.mapInArrow(_corrected, "lang string, a int, b int, value long")
    other = given.select("lang", F.col("code").alias("b"), F.col("floor").alias("floor_b"))
    mine = sizes.select("lang", F.col("code").alias("a"), F.col("floor").alias("p"), "floor", F.col("terms").alias("m"),
                        F.lit(True).alias("base"))
    steps = shares.groupBy("lang", F.col("code").alias("a"), "p", "floor").agg(F.count(F.lit(1)).alias("m")).withColumn(
        "base", F.lit(False))
    # A step is a share that m terms of a source have; against each other source it adds what it differs from the floor.
    met = mine.unionByName(steps.select(*mine.columns)).join(other, "lang").where("a != b")
    m, base, zero = F.col("m"), F.col("base"), F.lit(0).cast("long")
    parts = met.select("lang", F.explode(F.array(
        F.struct("a", "b", (m * (_excess("p", "floor_b") - F.when(base, zero).otherwise(
            _excess("floor", "floor_b")))).alias("value")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.when(base, zero).otherwise(
            m * (_excess("floor_b", "p") - _excess("floor_b", "floor"))).alias("value")))).alias("x"))
    sums = parts.select("lang", "x.*").unionByName(exact).groupBy("lang", "a", "b").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    name = given.select("lang", "code", "source")
    pairs = (sums.join(name.withColumnsRenamed({"code": "a"}), ["lang", "a"])
             .join(name.withColumnsRenamed({"code": "b", "source": "item"}), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(terms)
