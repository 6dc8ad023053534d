import numpy as np
import pytest

from viewtide.llm import tokens
from viewtide.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(TOKENIZER)


def plain(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids,
                    encoder.dtype).tobytes()


def test_letters_with_every_tail(encoder):
    """All letters below U+0250, alone and in words, before full stops and commas."""
    letters = [chr(c) for c in range(1, 0x250) if chr(c).isalpha()]
    words = [f"{before}{letter}{after}" for letter in letters for before in ("", "a", "A")
             for after in ("", ".", ",", ".,", "..", "a.", "'s", "1")]
    for order in (words, words[::-1]):
        assert encoder.encode(order) == [plain(encoder, word) for word in words][
            ::1 if order is words else -1]


def test_whole_texts_and_a_small_memory(table):
    texts = [r["text"] for r in table("documents").select("text").collect()]
    texts += [None, "", " \n", "İ. İ, Aİ. i̇.", "a<b> <|endoftext|> c", "one\x1ctwo three"]
    small = tokens.Encoder(TOKENIZER, remembered=50)
    for coder in (tokens.Encoder(TOKENIZER), small):
        for at in range(0, len(texts), 37):
            part = texts[at:at + 37]
            assert coder.encode(part) == [plain(coder, text or "") for text in part]


def test_ends_of_words_are_optional(encoder):
    """A vocabulary that does not mark them gives the same ids by the longer way."""
    other = tokens.Encoder(TOKENIZER)
    assert other.ends is not None
    other.ends = None
    text = "Several words, of letters. And more words"
    assert other.encode([text]) == encoder.encode([text]) == [plain(encoder, text)]
