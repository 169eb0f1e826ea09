"""Token ids of whole texts, for the token-file and packing operators.

``WordEncoder`` gives, for each text, exactly the ids of
``Tokenizer.encode(text, add_special_tokens=False)`` and the end id.

The tokenizers library spends most of its time on words that it has met
before.  Where a vocabulary drops white space and marks word ends (a BPE model
with an end-of-word suffix), no token crosses white space, so the ids of a
text are those of its words in order.  The distinct words of some texts are
then looked up in a table that each Python worker keeps, a word of Latin letters
in lower case and apart from the marks behind it, and only new ones go through
the library.  Splitting, telling words apart and joining their ids are Arrow
kernels.
Any other vocabulary, and any text with unusual white space, is encoded whole.

The table has two halves: when the newer one is full it becomes the older one,
and words met again move back to the newer.  So a worker's memory is bounded
and words that are in use stay.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Appended to each document.
END_ID = 1
#: Words that one text for the library holds: longer ones take it more time a word.
CALL_WORDS = 50
#: Characters of texts whose words are looked up together.
CALL_CHARS = 1_000_000
#: Words that a worker keeps, about: one call's new words may come on top.
MEMO_WORDS = 300_000

#: Space other than the six ASCII ones: libraries differ on these.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Latin letters, then closing marks: two separate pieces for the vocabulary.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = ".,;:!?"


class WordEncoder:
    """Ids of texts for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        # a worker has one core; the library's threads would each keep memory of their own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        top = max([END_ID, *vocabulary.values()])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.end = np.array([END_ID], self.dtype).tobytes()
        self.memo_words = memo_words
        self.memo: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        # asked of the library: the file as Python objects would stay in the worker's memory
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        splits = self.tokenizer.pre_tokenizer
        self.by_word = bool(suffix) and splits is not None and b'"Removed"' in splits.__getstate__()
        self.closes = np.zeros(top + 1, bool)
        if self.by_word:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _plain(self, words: list[str]) -> None:
        """Learn the ids of lower-case words of letters, a few dozen words a call."""
        chunks = [words[i:i + CALL_WORDS] for i in range(0, len(words), CALL_WORDS)]
        for chunk, raw in zip(chunks, self._ids([" ".join(x) for x in chunks])):
            stops = np.flatnonzero(self.closes[np.frombuffer(raw, self.dtype)]) + 1
            if len(stops) != len(chunk) or stops[-1] * self.dtype.itemsize != len(raw):
                self.memo.update(zip(chunk, self._ids(chunk)))
                continue
            start = 0
            for word, stop in zip(chunk, (stops * self.dtype.itemsize).tolist()):
                self.memo[word] = raw[start:stop]
                start = stop

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of words that :meth:`_documents` tells apart; new ones are learnt."""
        memo, older, new = self.memo, self.older, []
        found = list(map(memo.get, words))
        if None not in found:
            return found
        for word, ids in zip(words, found):
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    memo[word] = ids
        plain = [word for word in new if _LETTERS.fullmatch(word)]
        if plain:
            self._plain(plain)
        others = [word for word in new if not _LETTERS.fullmatch(word)] if len(plain) < len(new) else []
        if others:
            memo.update(zip(others, self._ids(others)))
        return [memo[word] if ids is None else ids for word, ids in zip(words, found)]

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of each word, the distinct ones looked up once."""
        words = words.dictionary_encode()
        found = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        return pa.array(found, pa.large_binary()).take(words.indices)

    def documents(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: empty), each with the end id."""
        done: list[np.ndarray] = []
        some, size = [], 0
        for text in texts:  # the words of a few texts at a time
            some.append(text or "")
            size += len(some[-1])
            if size >= CALL_CHARS:
                done += self._documents(some)
                some, size = [], 0
        done += self._documents(some)
        pa.default_memory_pool().release_unused()  # Arrow would keep some 40 MB for the next call
        return done

    def _documents(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) > self.memo_words // 2:
            self.memo, self.older = {"": b""}, self.memo
        whole = {k: text for k, text in enumerate(texts) if not self.by_word or _ODD_SPACE.search(text)}
        split = pc.ascii_split_whitespace(pa.array(["" if k in whole else text for k, text in enumerate(texts)], pa.string()))
        words = split.values.dictionary_encode()
        word = words.dictionary
        core = pc.utf8_rtrim(word, characters=_MARKS)
        plain = pc.match_substring_regex(core, f"^{_LETTERS.pattern}$")
        key = pc.if_else(plain, pc.utf8_lower(core), word)
        tail = pc.if_else(plain, pc.replace_substring_regex(word, f"^[^{_MARKS}]+", ""), "")
        ids = pc.binary_join_element_wise(self._ids_of(key), self._ids_of(tail), pa.scalar(b"", pa.large_binary()))
        joined = ids.take(words.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[split.offsets.to_numpy()]
        raw = memoryview(joined.buffers()[2] or b"")
        done = [b"".join((raw[start:end], self.end)) for start, end in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for k, ids in zip(whole, self._ids(list(whole.values())) if whole else []):
            done[k] = ids + self.end
        return [np.frombuffer(ids, self.dtype) for ids in done]


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, kept by the worker between tasks."""
    return WordEncoder(path)
