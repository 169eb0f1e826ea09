"""The table of words that a worker keeps for the token-file and packing operators."""

import public_tokenizers
from tokenizers import Tokenizer

from ratingspark.llm import tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _word(n: int) -> str:
    return "".join(chr(97 + n // 26 ** k % 26) for k in range(4))


def test_words_in_use_stay_and_the_table_is_bounded(monkeypatch):
    encoder, sent = tokens.WordEncoder(VOCABULARY, 200), []
    whole = Tokenizer.from_file(VOCABULARY)
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: sent.extend(texts) or ids(texts))
    for first in range(0, 3000, 50):
        text = " ".join(["unforgettable", *map(_word, range(first, first + 50))])
        got, = encoder.documents([text])
        assert got.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]
        assert len(encoder.memo) + len(getattr(encoder, "older", ())) <= 400
    assert " ".join(sent).split().count("unforgettable") == 1


def test_words_apart_from_their_marks_equal_whole_texts():
    texts = ["É. é!? É.é É,", "...", "A.B. c;d: x1; İstanbul ISTANBUL ŒUVRE. ßÿ, ÀÖØÞ! ÷×", " lead\ttrail \r\n", "",
             "can't CAN'T. 'll; ll'", "a" * 3000 + "!!!", "日本語。 日本語. ab日本"]
    whole = Tokenizer.from_file(VOCABULARY)
    for memo in (2, 1000):
        got = tokens.WordEncoder(VOCABULARY, memo).documents(texts * 2)
        assert [x.tolist() for x in got] == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts * 2]
