"""Secret scans: patterns, and a randomness test battery for everything else.

Three patterns give the base spans.  Beyond them, runs of 20 and more
characters of the base64 alphabets are candidates.  A candidate's encoding is
inferred from the characters that it uses (hex, base32, base36, base62,
base64; plain words and numbers have none).  A run that fits no encoding is
split at / + _ - and its parts are candidates.  Three tests ask whether it
could be a random string over that alphabet: a chi-squared test for equal
use of the symbols, a runs test about the middle of the alphabet, and the
correlation of neighbours.  A candidate's p-value is Bonferroni's over the
three.

Short strings are tested with little power and long ones with much, so the
false discoveries are controlled within classes of encoding and length:
Benjamini-Hochberg at level ``FDR`` over all candidates of a class finds those
that are not random; the others are reported.  The step-up threshold comes
from a histogram of log p-values, whose size is fixed, so no class is ranked
in one task.

All of it is built-in functions over one pass of the texts; only positions,
no texts, are written in between.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty

#: Kinds in order, their patterns, and the lengths they need.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_CHARS = 6
ACCESS_CHARS = 20

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
PART = r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}"
FDR = 0.01
#: Encodings: name, pattern, alphabet.  The first that fits is taken.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("BASE36", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
)
#: Histogram of -ln p: bins a unit, and the last bin.
BINS = 64
LAST_BIN = 40 * BINS


def matches(text: Column, pattern: str, good) -> Column:
    """Leftmost non-overlapping matches as ``(start, end, string)`` in code points.

    Positions are running sums over the pieces between matches.  ``good`` tells
    which matches to keep; the others are passed over like them.
    """
    between = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(between, hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))  # no hit follows the last piece
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.when(x["hit"].isNotNull() & good(x["hit"]), F.array_append(state["kept"], span))
                        .otherwise(state["kept"]).alias("kept"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("kept")), step, lambda s: s["kept"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _assigned(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 1)) >= ASSIGN_CHARS


def base_spans(text: Column) -> list[Column]:
    """Matches of the three kinds of patterns, in order."""
    return [matches(text, ASSIGN, _assigned),
            matches(text, ACCESS, lambda hit: F.length(hit) >= ACCESS_CHARS),
            matches(text, HEX, lambda hit: F.lit(True))]


def encoding(run: Column) -> Column:
    """Number of the first encoding whose characters a run uses, or null."""
    found = F.lit(None).cast("int")
    for n, (_, pattern, _) in reversed(list(enumerate(ENCODINGS))):
        found = F.when(run.rlike(pattern), n).otherwise(found)
    return found


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic curve (error below 0.0002)."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1.0 / (1.0 + F.exp(0.07056 * z * z * z + 1.5976 * z))


def p_value(symbols: Column, size: Column) -> Column:
    """Bonferroni's p-value that ``symbols`` (numbers from 0) are random below ``size``."""
    n, k = F.size(symbols).cast("double"), size.cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    doubles = F.transform(symbols, lambda x: x.cast("double"))
    # Chi-squared of the symbol counts, by Wilson and Hilferty's cube root.
    counts = F.transform(F.array_distinct(symbols), lambda s: F.size(F.filter(symbols, lambda x: x == s)).cast("double"))
    chi = total(F.transform(counts, lambda c: c * c)) * k / n - n
    df = k - 1.0
    uneven = _tail((F.pow(F.greatest(chi, F.lit(0.0)) / df, 1.0 / 3) - (1.0 - 2.0 / (9.0 * df))) / F.sqrt(2.0 / (9.0 * df)))
    # Runs below and above the middle of the alphabet.
    high = F.transform(doubles, lambda x: x >= k / 2)
    later, earlier = F.slice(high, F.lit(2), F.size(high)), F.slice(high, F.lit(1), F.size(high) - 1)
    runs = 1.0 + total(F.zip_with(earlier, later, lambda a, b: (a != b).cast("double")))
    ups = total(F.transform(high, lambda x: x.cast("double")))
    pairs = 2.0 * ups * (n - ups)
    spread = pairs * (pairs - n) / (n * n * (n - 1.0))
    rhythm = F.when((pairs > 0) & (spread > 0), 2.0 * _tail(F.abs(runs - 1.0 - pairs / n) / F.sqrt(spread))).otherwise(0.0)
    # Correlation of neighbours.
    mean = total(doubles) / n
    off = F.transform(doubles, lambda x: x - mean)
    squares = total(F.transform(off, lambda x: x * x))
    products = total(F.zip_with(F.slice(off, F.lit(1), F.size(off) - 1), F.slice(off, F.lit(2), F.size(off)),
                                lambda a, b: a * b))
    serial = F.when(squares > 0, 2.0 * _tail(F.abs(products / squares + 1.0 / n) * F.sqrt(n))).otherwise(0.0)
    return F.least(F.lit(1.0), 3.0 * F.least(uneven, rhythm, serial))


def _candidate(span: Column) -> Column:
    """A run as (start, end, encoding, length class, bin of its p-value); encoding null if it has none."""
    core = F.rtrim(span["hit"], F.lit("="))
    code = encoding(core)
    alphabets = F.array(*[F.lit(a) for _, _, a in ENCODINGS])
    alphabet = F.element_at(alphabets, F.coalesce(code, F.lit(0)) + 1)
    symbols = F.transform(F.filter(F.split(core, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c) - 1)
    p = p_value(symbols, F.length(alphabet))
    bin_ = F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * BINS), F.lit(LAST_BIN)).cast("int")
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), code.alias("encoding"),
                    F.floor(F.log2(F.length(core).cast("double")) * 2).cast("int").alias("size"),
                    F.when(code.isNotNull(), bin_).alias("bin"))


def candidates(text: Column) -> Column:
    """Runs, or parts of runs, that could be random strings, as an array of ``_candidate``."""
    telling = lambda hit: hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")

    def parts(run: Column) -> Column:
        whole = encoding(F.rtrim(run["hit"], F.lit("="))).isNotNull()
        moved = F.transform(matches(run["hit"], PART, telling), lambda part: F.struct(
            (run["start"] + part["start"]).alias("start"), (run["start"] + part["end"]).alias("end"),
            part["hit"].alias("hit")))
        return F.when(whole, F.array(run)).otherwise(moved)

    spans = F.flatten(F.transform(matches(text, RUN, telling), parts))
    return F.filter(F.transform(spans, _candidate), lambda c: c["encoding"].isNotNull())


def thresholds(found: DataFrame, fdr: float = FDR) -> dict[tuple[int, int], int]:
    """Per (encoding, length class): the smallest bin of -ln p that is called not random.

    ``found(candidates)``.  Benjamini-Hochberg: the largest p with p <= fdr *
    rank / number of tests, ranks counted over all candidates of the class.
    The result has a row for each class: a handful of encodings times the
    logarithm of the longest run.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.encoding", "c.size", "c.bin")
    bins = each.groupBy("encoding", "size", "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("encoding", "size")
    ranked = bins.withColumn("rank", F.sum("n").over(group.orderBy(F.col("bin").desc()))).withColumn(
        "all", F.sum("n").over(group))
    most = F.exp(-F.col("bin") / float(BINS))  # the largest p of a bin
    called = ranked.where(most <= fdr * F.col("rank") / F.col("all"))
    return {(r["encoding"], r["size"]): r["bin"]
            for r in called.groupBy("encoding", "size").agg(F.min("bin").alias("bin")).collect()}


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Secrets of ``docs(doc_id, text)``: one row per document.

    Columns: doc_id, base (spans of the patterns) and spans (those and the
    random strings beside them), arrays of (start, kind, end) with the number
    of the kind in ``KINDS``, in order of start, then kind.  Null texts are
    empty; null ids and repeated rows are documents like others; an empty
    table gives no rows; other columns are ignored.
    """
    def of_kind(kind: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))

    spans = F.array_sort(F.concat(*[F.transform(found, of_kind(kind))
                                    for kind, found in enumerate(base_spans(F.col("text")))]))
    found = saved(docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", spans.alias("base"), candidates(F.col("text")).alias("candidates")), "spans")
    limits = thresholds(found, fdr)
    random = lambda c: F.lit(True)
    if limits:
        given = F.create_map(*[x for (e, s), b in limits.items() for x in (F.lit(e * 1000 + s), F.lit(b))])
        random = lambda c: c["bin"] < F.coalesce(given[c["encoding"] * 1000 + c["size"]], F.lit(LAST_BIN + 1))
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    more = F.transform(F.filter("candidates", lambda c: random(c) & apart(c)), of_kind(KINDS.index("random")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
