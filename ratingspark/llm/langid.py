"""Language ID by compression.

A language's model is a bounded sample of its labelled texts, used as a raw-
content dictionary of zstandard.  A text is cut into blocks; each block is
compressed with each language's dictionary and the language with the smallest
total wins.  A few bytes more or less decide short texts, so these are also
compressed with each of ``PARTS`` parts of the sample, and the sizes are added.
The margin, how much smaller the best size is than the runner-up, is the score;
predictions below ``reject_below`` are marked as rejected.

The sample is the only thing that reaches the driver: ``SAMPLE_DOCS`` texts a
language, ``SAMPLE_CHARS`` characters of each, chosen by a hash of the id.
Prediction is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: The bound of the fit: texts a language, characters of each.
SAMPLE_DOCS = 96
SAMPLE_CHARS = 1500
#: Lazy matching of four bytes and more: word parts count, at moderate cost.
PARAMETERS = dict(strategy=5, min_match=4, window_log=18, hash_log=16, chain_log=16, search_log=5,
                  target_length=32, write_checksum=False, write_content_size=False, write_dict_id=False)
#: The same for a part of a sample, which is small: so are its tables.
PART_PARAMETERS = PARAMETERS | dict(window_log=15, hash_log=13, chain_log=13)
#: Characters compressed at once: dictionaries weigh the same in long texts.
BLOCK_CHARS = 2048
#: Texts of fewer characters are also compressed with the parts of the sample.
SHORT_CHARS = 512
PARTS = 16
#: Margins below this are rejected.
REJECT_BELOW = 0.005
UNKNOWN = "und"
FOLDS = 5


def fold() -> Column:
    """Remainder that decides what is held out (0) and what is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def held_out() -> Column:
    """Whether a document is held out (null ids: no)."""
    return F.coalesce(fold() == 0, F.lit(False))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Sample texts of the languages in ``docs(doc_id, text, lang)``.

    Rows with a null id, text or lang, and rows of the held-out fold, are not
    learned from.  The languages are a small closed set.
    """
    known = docs.where((fold() != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "_sample")
    picked = (known.select("lang", "doc_id", F.substring("text", 1, sample_chars).alias("_sample"))
              .withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= sample_docs))
    texts: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "_n").collect():  # bounded by the sample's parameters
        texts.setdefault(row["lang"], []).append(row["_sample"])
    return texts


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def prepared(text: str) -> bytes:
    """Lower-case letters; all else is one space."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


class Classifier:
    """Smallest compressed size over the dictionaries of the languages."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        self.whole = [self._compressor(samples[x]) for x in self.langs]
        self.parts = [[self._compressor(samples[x][i::PARTS], PART_PARAMETERS) for i in range(PARTS)]
                      for x in self.langs]

    @staticmethod
    def _compressor(texts: list[str], parameters: dict = PARAMETERS) -> zstandard.ZstdCompressor:
        raw = zstandard.ZstdCompressionDict(prepared(" ".join(texts) or " " * 8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given = zstandard.ZstdCompressionParameters(**parameters)
        raw.precompute_compress(compression_params=given)
        return zstandard.ZstdCompressor(dict_data=raw, compression_params=given)

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of the whole text, by language."""
        blocks = [prepared(text[i:i + BLOCK_CHARS]) for i in range(0, len(text), BLOCK_CHARS)]
        found = [sum(len(c.compress(b)) for b in blocks) for c in self.whole]
        if len(text) < SHORT_CHARS:
            found = [n + sum(len(c.compress(b)) for c in parts for b in blocks) for n, parts in zip(found, self.parts)]
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, margin); ``und`` and 0 without letters or languages."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best]
        return self.langs[best], 1.0 - sizes[best] / min(others) if others else 1.0


def predict(docs: DataFrame, samples: dict[str, list[str]], reject_below: float = REJECT_BELOW, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``, one row per row.

    ``text`` names the column of texts; ``doc.text`` is the field of a struct ``doc``.

    Null, empty and letterless texts, and all texts if nothing was learned,
    are ``und`` with score 0 and rejected.  Of equal sizes the first language
    by code point wins, with score 0.  Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    column, *fields = text.split(".")
    at = docs.columns.index(column)
    given = docs.sparkSession.sparkContext.broadcast(samples)  # bounded by the sample's parameters

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(given.value)
        for batch in slices(batches):
            texts = batch.column(at)
            for field in fields:
                texts = texts.field(field)
            found = [classifier.predict(t) for t in texts.to_pylist()]
            langs, scores = [x[0] for x in found], [x[1] for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([a == UNKNOWN or b < reject_below for a, b in found], pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "rejected"])
            pa.default_memory_pool().release_unused()  # Arrow would keep what an earlier batch took

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(add, schema)
