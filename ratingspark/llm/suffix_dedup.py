"""Suffix-array dedup: difference-cover samples, one suffix bucket at a time.

A byte goes if a string of ``length`` bytes that covers it also starts
elsewhere.  So suffixes need to be told apart to that depth only.

D is a difference cover modulo v: for any two positions i and j there is a
d < v such that i + d and j + d both are, modulo v, in D.  The suffixes that
start at such positions are the cover sample (one in ten).  They are compared
first, on W = length - v + 1 bytes, and those that are equal get one rank; most
have a rank of their own and play no part from then on.

If the suffixes at i and j agree on ``length`` bytes, then those at i + d and
j + d agree on W bytes and so share a rank.  A rank is therefore a bucket of
suffixes, those that start at most v - 1 bytes before its sample positions.
Within it the long part, W bytes, is already known to be equal: a tie that the
rank resolves.  What is compared are the at most v - 1 bytes before and after,
and they are all that a bucket's rows carry.  Ranks are dealt to ``passes``
parts which are worked on one after another, both to rank the sample and to
sort the buckets, so that only a part of the suffixes is on disk at any time.

Equal texts are one text.  A rank with more than ``HOT_ROWS`` sample positions
is not sorted in one task: the suffixes before them are named by a 128-bit
hash of their ``length`` bytes, counted with partial sums.  Intermediate tables
are deleted once they have been read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_folder
from .common import saved, shared_folder, slices, small, written

LENGTH = 400
PASSES = 4
#: Sample positions of a rank that one task sorts at most; parts in which texts are shuffled; rows that a task
#: sorts at a time; bytes hashed at a time.
HOT_ROWS = 1000
WORK_PARTS = 2
SORT_ROWS = 10_000
PIECE = 1 << 16
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_CODES = np.array([xxhash.xxh64_intdigest(bytes([c]), 13) | 1 for c in range(256)], np.uint64)


def difference_cover(period: int) -> tuple[int, np.ndarray]:
    """``(v, D)`` with the largest v up to ``period`` of the form q*q + q + 1, q prime, and |D| = q + 1.

    D are the zeros of a linear recurrence of order three modulo q (a perfect
    difference set).  Below 7 every position is in the cover.
    """
    primes = [q for q in range(2, int(max(period, 4) ** 0.5) + 1) if all(q % p for p in range(2, q))]
    for q in reversed([q for q in primes if q * q + q + 1 <= period]):
        v = q * q + q + 1
        for code in range(q ** 3):
            a, b, c = code // (q * q), code // q % q, code % q
            s = [0, 0, 1]
            for _ in range(v - 3):
                s.append((a * s[-1] + b * s[-2] + c * s[-3]) % q)
            zeros = [i for i, x in enumerate(s) if x == 0]
            if len(zeros) == q + 1 and len({(i - j) % v for i in zeros for j in zeros}) == v:
                return v, np.array(zeros)
    return 1, np.array([0])


class Sampler:
    """Names of the strings of W bytes at the cover's positions: equal strings have equal names."""

    def __init__(self, length: int):
        self.length = length
        self.period, cover = difference_cover(max(1, length // 2))
        self.width = length - self.period + 1
        self.step = max(1, PIECE // self.period) * self.period
        rounds = -(-(self.step + self.width) // self.period)
        self.grid = (np.arange(rounds)[:, None] * self.period + cover).ravel()

    def _powers(self) -> None:
        if not hasattr(self, "powers"):
            n = self.step + self.width
            self.powers, self.inverse = (np.cumprod(np.array([1] + [base] * n, np.uint64))
                                         for base in (_ODD[0], pow(_ODD[0], -1, 1 << 64)))

    def parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """``(row, at, name)`` arrays of the sample positions of texts ``data[start:end]``, about a piece at a time."""
        self._powers()
        held, size = [], 0
        for row, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
            for at in range(0, max(0, end - start - self.width + 1), self.step):
                stop = min(start + at + self.step + self.width - 1, end)
                if held and (size + stop - start - at > self.step or held[-1][3] != start + at):
                    yield self._named(data, held)
                    held, size = [], 0
                held.append((row, at, start + at, stop))
                size += stop - start - at
        if held:
            yield self._named(data, held)

    def _named(self, data: np.ndarray, held: list[tuple]) -> tuple:
        first, last = held[0][2], held[-1][3]
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_CODES[data[first:last]] * self.powers[:last - first], out=sums[1:])
        counts = np.searchsorted(self.grid, [stop - start - self.width + 1 for _, _, start, stop in held])
        local = [self.grid[:n] for n in counts]
        at = np.concatenate([g + base for g, (_, base, _, _) in zip(local, held)])
        where = np.concatenate([g + (start - first) for g, (_, _, start, _) in zip(local, held)])
        name = (sums[where + self.width] - sums[where]) * self.inverse[where]
        name ^= name >> np.uint64(32)
        name *= np.uint64(_ODD[1])
        name ^= name >> np.uint64(29)
        return np.repeat([row for row, *_ in held], counts), at, name.view(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where its values start and end."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends[:-1], ends[1:]


def sample(texts: DataFrame, sampler: Sampler) -> DataFrame:
    """``(name, uid, at)`` of the cover sample of ``texts(uid, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            uid, found = batch.column("uid").to_numpy(), list(sampler.parts(*_texts(batch.column("text"))))
            if found:
                row, at, name = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(uid[row]), pa.array(at.astype(np.int32))],
                                                 names=["name", "uid", "at"])

    return texts.select("uid", "text").mapInArrow(run, "name long, uid long, at int")


def ranked_sample(sampled: DataFrame, folder: str, passes: int) -> DataFrame:
    """``(uid, at, name, n)``: sample positions whose name ``n`` > 1 positions have."""
    spark = sampled.sparkSession
    for part in range(passes):
        mine = sampled.where(F.pmod("name", F.lit(passes)) == part)
        ranks = written(mine.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{folder}/ranks-{part}")
        given = F.broadcast(ranks) if small(ranks, 16) else ranks
        written(mine.join(given, "name").select("uid", "at", "name", "n"), f"{folder}/hits/part={part}")
        delete_folder(spark, f"{folder}/ranks-{part}")
    return spark.read.schema("uid long, at int, name long, n long").parquet(f"{folder}/hits/*")


def _hashes(rows: np.ndarray, odd: int) -> np.ndarray:
    """Hashes of the first 0, 1, .. bytes of each row."""
    out = np.zeros((rows.shape[1] + 1, len(rows)), np.uint64)
    for k in range(rows.shape[1]):
        out[k + 1] = (out[k] + _CODES[rows[:, k]]) * np.uint64(odd)
        out[k + 1] ^= out[k + 1] >> np.uint64(31)
    return out


def _matrix(values: list[bytes], width: int, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as rows of bytes, read away from the sample, and their lengths."""
    sizes = np.array([len(x) for x in values])
    padded = b"".join(x.rjust(width, b"\0") if backward else x.ljust(width, b"\0") for x in values)
    rows = np.frombuffer(padded, np.uint8).reshape(len(values), width)
    return (rows[:, ::-1] if backward else rows), sizes


def repeated_spans(bucket: np.ndarray, left: list[bytes], right: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least and the most bytes before its sample at which a repeated suffix starts (-1: none).

    Rows of one bucket share a rank.  The suffix that starts d bytes before a
    row's sample is repeated if another row has the same d bytes before and
    the same ``reach`` - d bytes after.
    """
    least, most = np.full(len(bucket), -1), np.full(len(bucket), -1)
    a, a_size = _matrix(left, reach, True)
    b, b_size = _matrix(right, reach, False)
    _, start, count = np.unique(bucket, return_index=True, return_counts=True)
    # two rows: how far they agree on both sides
    i = start[count == 2]
    if len(i):
        def agree(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            differs = rows[i] != rows[i + 1]
            first = np.where(differs.any(axis=1), differs.argmax(axis=1), reach) if reach else np.zeros(len(i), int)
            return np.minimum(first, np.minimum(sizes[i], sizes[i + 1]))

        before, after = agree(a, a_size), agree(b, b_size)
        hit = before + after >= reach
        for k in (i[hit], i[hit] + 1):
            least[k], most[k] = reach - after[hit], before[hit]
    # more rows: the suffixes at each distance are sorted
    rows = np.flatnonzero(np.repeat(count > 2, count))
    if len(rows):
        own = bucket[rows].astype(np.uint64) * np.uint64(_ODD[2])
        before, after = ([_hashes(x[rows], odd) for odd in _ODD[:2]] for x in (a, b))
        for d in range(reach + 1):
            able = (a_size[rows] >= d) & (b_size[rows] >= reach - d)
            key, check = ((x[d][able] * np.uint64(_ODD[2]) + y[reach - d][able]) ^ own[able] for x, y in zip(before, after))
            order = np.argsort(key, kind="stable")
            key, check = key[order], check[order]
            same = (key[1:] == key[:-1]) & (check[1:] == check[:-1])
            twice = np.zeros(len(key), bool)
            twice[1:] |= same
            twice[:-1] |= same
            k = rows[np.flatnonzero(able)[order[twice]]]
            least[k] = np.where(least[k] < 0, d, least[k])
            most[k] = d
    return least, most


def _cold(work: DataFrame, sampler: Sampler, part: int, passes: int, hot_rows: int) -> DataFrame:
    """``(uid, start, end)`` from buckets of up to ``hot_rows`` rows, of one part of the ranks."""
    reach, width, length = sampler.period - 1, sampler.width, sampler.length

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: dict[str, list] = {c: [] for c in ("name", "name2", "uid", "at", "before", "after")}
            for uid, text, hits in zip(*[batch.column(c) for c in ("uid", "text", "hits")]):
                text, uid, hits = text.as_py(), uid.as_py(), hits.values
                name, at, n = (hits.field(c).to_numpy() for c in ("name", "at", "n"))
                mine = (name % passes == part) & (n <= hot_rows)
                for name, at in zip(name[mine].tolist(), at[mine].tolist()):
                    end = at + width
                    out["name"].append(name)
                    out["name2"].append(xxhash.xxh3_64_intdigest(text[at:end]) - (1 << 63))
                    out["uid"].append(uid)
                    out["at"].append(at)
                    out["before"].append(text[max(0, at - reach):at])
                    out["after"].append(text[end:end + reach])
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("name", pa.int64()), ("name2", pa.int64()), ("uid", pa.int64()), ("at", pa.int32()),
                ("before", pa.binary()), ("after", pa.binary())]))

    def spans(held: pa.Table) -> pa.RecordBatch:
        name, name2, uid, at = (held.column(c).to_numpy() for c in ("name", "name2", "uid", "at"))
        bucket = np.cumsum(np.concatenate([[0], (name[1:] != name[:-1]) | (name2[1:] != name2[:-1])]))
        least, most = repeated_spans(bucket, held.column("before").to_pylist(), held.column("after").to_pylist(), reach)
        some = most >= 0
        return pa.RecordBatch.from_arrays([pa.array(uid[some]), pa.array((at - most)[some].astype(np.int32)),
                                           pa.array((at - least)[some].astype(np.int32) + length)], names=["uid", "start", "end"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in slices(batches, 4096):
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows >= SORT_ROWS:
                name = held.column("name").to_numpy()
                cut = int(np.searchsorted(name, name[-1]))  # the last bucket may go on
                if cut:
                    yield spans(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield spans(held)

    met = work.mapInArrow(rows, "name long, name2 long, uid long, at int, before binary, after binary")
    return met.repartition("name").sortWithinPartitions("name", "name2").mapInArrow(sort, "uid long, start int, end int")


def _hot(work: DataFrame, sampler: Sampler, part: int, passes: int, hot_rows: int) -> DataFrame:
    """``(uid, start, end)`` of repeated suffixes near sample positions of larger buckets, of one part of the suffixes."""
    reach, length = sampler.period - 1, sampler.length

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            keys, uids, starts = [], [], []
            for uid, text, hits in zip(*[batch.column(c) for c in ("uid", "text", "hits")]):
                hits = hits.values
                at = hits.field("at").to_numpy()[hits.field("n").to_numpy() > hot_rows]
                if not len(at):
                    continue
                text, uid = text.as_py(), uid.as_py()
                near = np.zeros(len(text) + 1, np.int64)
                np.add.at(near, np.maximum(at - reach, 0), 1)
                np.add.at(near, at + 1, -1)
                for i in np.flatnonzero(np.cumsum(near)[:max(0, len(text) - length + 1)]).tolist():
                    key = xxhash.xxh3_128_digest(text[i:i + length])
                    if key[0] % passes == part:
                        keys.append(key)
                        uids.append(uid)
                        starts.append(i)
            yield pa.RecordBatch.from_pydict({"key": keys, "uid": uids, "start": starts}, pa.schema([
                ("key", pa.binary()), ("uid", pa.int64()), ("start", pa.int32())]))

    named = work.mapInArrow(name, "key binary, uid long, start int")
    twice = saved(named.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "hot")
    given = F.broadcast(twice) if small(twice, 48) else twice
    return named.join(given, "key", "left_semi").select("uid", "start", (F.col("start") + length).alias("end"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, passes: int = PASSES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept`` (the remaining bytes, binary).

    Every byte of ``text`` (UTF-8, null: empty) goes that is covered by a
    string of ``length`` bytes which also starts elsewhere, in the same
    document or another; strings are judged on the input.  Repeated rows and
    texts are documents of their own, whatever their ids.  Texts shorter than
    ``length`` stay whole; other columns stay as they are (columns of the
    four result names are replaced).  An empty table gives no rows.
    """
    if length < 1 or passes < 1:
        raise ValueError("length and passes are at least 1")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    results = ("n_bytes", "n_removed", "n_spans", "kept")
    kept = [c for c in docs.columns if c not in results]
    spark = docs.sparkSession
    folder = shared_folder(spark, "suffixes")
    base = written(docs.select(F.struct(*kept).alias("doc"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("uid"), "doc", "text", F.length("text").alias("n_bytes"),
        F.unhex(F.sha2("text", 256)).alias("sha")), f"{folder}/texts", "zstd")
    sampler = Sampler(length)

    # equal texts are one
    long_texts = base.where(F.col("n_bytes") >= length)
    groups = written(long_texts.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.min("uid").alias("uid")), f"{folder}/copies")
    first = groups.select("uid")
    first = F.broadcast(first) if small(groups, 16) else first
    texts = long_texts.join(first, "uid", "left_semi")

    sampled = written(sample(texts, sampler), f"{folder}/sample")
    found = ranked_sample(sampled, folder, passes)
    delete_folder(spark, f"{folder}/sample")
    hits = written(found.groupBy("uid").agg(F.collect_list(F.struct("name", "at", "n")).alias("hits")), f"{folder}/by-text")
    delete_folder(spark, f"{folder}/hits")
    for part in range(WORK_PARTS):  # texts are shuffled a part at a time
        mine = F.pmod("uid", F.lit(WORK_PARTS)) == part
        written(hits.where(mine).join(long_texts.where(mine).select("uid", "text"), "uid"), f"{folder}/work/part={part}", "zstd")
    work = spark.read.schema(hits.join(long_texts.select("uid", "text"), "uid").schema).parquet(f"{folder}/work/*")
    delete_folder(spark, f"{folder}/by-text")
    hot = not work.where(F.exists("hits", lambda h: h["n"] > hot_rows)).isEmpty()
    spans = [written(_cold(work, sampler, part, passes, hot_rows), f"{folder}/cold-{part}") for part in range(passes)]
    if hot:
        spans += [written(_hot(work, sampler, part, passes, hot_rows), f"{folder}/hot-{part}") for part in range(passes)]
    delete_folder(spark, f"{folder}/work")
    listed = reduce(DataFrame.unionByName, spans).distinct().groupBy("uid").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))

    twice = groups.where("copies > 1").select("sha", F.lit(True).alias("whole"))
    twice = F.broadcast(twice) if small(twice, 64) else twice
    marked = base.join(twice, "sha", "left").join(listed, "uid", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for text, whole, spans in zip(*[batch.column(c) for c in ("text", "whole", "spans")]):
                text = text.as_py()
                found = [(0, len(text))] if whole.as_py() else []
                if not found and spans.is_valid:
                    spans = spans.values
                    start, end = (spans.field(c).to_numpy() for c in ("start", "end"))
                    order = np.argsort(start, kind="stable")
                    start, end = start[order], np.maximum.accumulate(end[order])
                    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                    last = np.concatenate([new[1:], [len(start)]]) - 1
                    found = list(zip(start[new].tolist(), end[last].tolist()))
                stay, at = [], 0
                for start, end in found:
                    stay.append(text[at:start])
                    at = end
                stay.append(text[at:])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(end - start for start, end in found))
                out["n_spans"].append(len(found))
                out["kept"].append(b"".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(out[c], pa.int64()) for c in results[:3]], pa.array(out["kept"], pa.binary())],
                names=["doc", *results])

    schema = marked.select("doc").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    for part in range(WORK_PARTS):
        mine = marked.where(F.pmod("uid", F.lit(WORK_PARTS)) == part).select("doc", "text", "whole", "spans")
        written(mine.mapInArrow(cut, schema), f"{folder}/kept/part={part}", "zstd")
    for done in ("texts", "copies", *[f"{kind}-{part}" for kind in ("cold", "hot") for part in range(passes)]):
        delete_folder(spark, f"{folder}/{done}")
    return spark.read.schema(schema).parquet(f"{folder}/kept/*").select("doc.*", *results)
