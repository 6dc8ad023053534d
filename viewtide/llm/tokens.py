"""Token ids of texts, through files of the ``tokenizers`` library.

Ids travel as bytes: little-endian unsigned integers of 16 bits where the
vocabulary allows it, else of 32 bits. A tokenizer is named by the path of its
file, which every executor must be able to read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np

# Words kept in a task's memory; beyond it the memory starts anew.
REMEMBERED = 2_000_000
_TOGETHER = 256
_TAIL = ".,"
_LATIN, _DOTTED = "\u0180", "\u0130"

_ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]+")
# Characters that str.split() and tokenizers may judge differently.
_UNUSUAL_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁯　﻿]")


class Encoder:
    """Encodes whole texts.

    Where the tokenizer drops white space, as one that ends words does, a text
    has the ids of its words in a row; then each word is encoded once and
    remembered. Any other tokenizer gets the texts as they are.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(
            "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        plain = [self._plain(text) for text in ("ab", "cd", "ab cd", " \n")]
        self.by_word = plain[0] + plain[1] == plain[2] and not plain[3]
        self.by_part = self.by_word and all(
            self._plain(a) == self._plain(b) + self._plain(c) for a, b, c in
            (("Cab,", "cab", ","), ("the.,", "the", ".,"), ("Éa.", "éa", ".")))
        self.ends = self._word_ends() if self.by_part else None
        self.mark = next(
            ((token.content, number) for number, token
             in self.tokenizer.get_added_tokens_decoder().items()
             if token.special and not (token.lstrip or token.rstrip or token.single_word)), None)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                        self.dtype).tobytes()

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a word, if the vocabulary says so."""
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        if not suffix:
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        ends[[number for token, number in self.tokenizer.get_vocab(
            with_added_tokens=False).items() if token.endswith(suffix)]] = True
        return ends

    def _learn(self, words: Iterable[str]) -> None:
        """Ids of unknown words.

        A word of Latin letters with full stops or commas behind it has the ids
        of its letters, small ones, and then those of the rest. Most new words
        are known ones in another dress.
        """
        known = self.words
        if not self.by_part:
            self._encode_words(list(words))
            return
        whole, parts, new = [], [], set()
        for word in words:
            core = word if word.isalpha() else word.rstrip(_TAIL)
            # One capital has two small letters, of which the second is a mark.
            if not core.isalpha() or not core.isascii() and (
                    max(core) >= _LATIN or _DOTTED in core):
                whole.append(word)
                continue
            small = core if core[0].islower() else core[0].lower() + core[1:]
            if small not in known:
                new.add(small)
            if len(small) < len(word) or small != word:
                tail = word[len(core):]
                parts.append((word, small, tail))
                if tail not in known:
                    whole.append(tail)
        self._encode_letters([word for word in new if word not in known])
        self._encode_words(list(dict.fromkeys(whole)))
        known.update([(word, known[core] + known[tail]) for word, core, tail in parts])

    def _encode_letters(self, new: list[str]) -> None:
        """Encodes words of letters, many in one call. Where the vocabulary marks the ends
        of words, these tell the words apart and a space between them is enough."""
        if self.ends is None:
            self._encode_words(new)
            return
        groups = [new[i:i + _TOGETHER] for i in range(0, len(new), _TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast(
            [" ".join(group) for group in groups], add_special_tokens=False)
        size = self.dtype.itemsize
        for group, found in zip(groups, encoded, strict=True):
            ids = np.array(found.ids, self.dtype)
            last = ((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()
            if len(last) != len(group):
                self._encode_words(group)
                continue
            data = ids.tobytes()
            self.words.update((word, data[a:b]) for word, a, b in zip(
                group, [0, *last[:-1]], last, strict=True))

    def _encode_words(self, new: list[str]) -> None:
        """Encodes words, many in one call with a special token between them."""
        if self.mark is None:
            joined: list[str] = []
            alone = new
        else:
            name, number = self.mark
            alone = [word for word in new if "<" in word or ">" in word]
            joined = [word for word in new if not ("<" in word or ">" in word)]
            groups = [joined[i:i + _TOGETHER] for i in range(0, len(joined), _TOGETHER)]
            encoded = self.tokenizer.encode_batch_fast(
                [name.join(group) for group in groups], add_special_tokens=False)
            for group, found in zip(groups, encoded, strict=True):
                ids = np.array(found.ids, self.dtype)
                data, cuts = ids.tobytes(), np.flatnonzero(ids == number)
                size = self.dtype.itemsize
                first = [0, *((cuts + 1) * size).tolist()]
                last = [*(cuts * size).tolist(), len(data)]
                self.words.update(
                    (word, data[a:b]) for word, a, b in zip(group, first, last, strict=True))
        for word in alone:
            self.words[word] = self._plain(word)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of every text, without special tokens; null and empty texts have none."""
        if not self.by_word:
            return [self._plain(text or "") for text in texts]
        known, out, waiting, new = self.words, [], [], set()
        for text in texts:
            words = ((_ASCII_SPACE.split(text) if _UNUSUAL_SPACE.search(text) else text.split())
                     if text else [])
            found = list(map(known.get, words))
            try:
                out.append(b"".join(found))
            except TypeError:  # a word that is not known yet
                waiting.append((len(out), words))
                out.append(b"")
                new.update([word for word, ids in zip(words, found, strict=True) if ids is None])
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(chain.from_iterable(words for _, words in waiting))
        self._learn(new)
        for place, words in waiting:
            out[place] = b"".join(map(known.__getitem__, words))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)


def widened(ids: bytes, dtype: np.dtype) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()
