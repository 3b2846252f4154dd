"""Loading the public tokenizer inside tasks, and encoding whole texts word by word."""

from __future__ import annotations

import itertools
import os

import numpy as np

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 1_000_000  # of a Python worker, kept from task to task


# Words of a-z with some of these marks after them or none: VOCABULARY's normalizer and pre-tokenizer change neither and cut
# between the two only, so that the model alone gives their ids, in less time than the whole tokenizer.
MARKS = b'.,;:!?*#$%&()"'


def load(name: str = VOCABULARY):
    """The library's tokenizer; one thread, since Spark runs a task per core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def _put(a: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``a`` with ``new`` from ``at`` on; where there is no room, a copy with twice the room, so that copies are few."""
    if at + len(new) > len(a):
        more = np.empty(2 * (at + len(new)), a.dtype)
        more[:at] = a[:at]
        a = more
    a[at:at + len(new)] = new
    return a


class WordEncoder:
    """Token ids of texts from the ids of their blank-separated words.

    The tokenizer drops white space and none of its tokens reaches across it, so a text's ids are those of its
    words in a row; each distinct word is encoded once while it stays in the cache.
    """

    def __init__(self, name: str = VOCABULARY, cache_words: int = CACHE_WORDS):
        self.tokenizer, self.cache_words = load(name), cache_words
        self.model, self.plain = self.tokenizer.model, name == VOCABULARY
        self._reset()

    def _reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # ids of word i: ids[ends[i]:ends[i + 1]]; both have room for more

    def _learn(self, words: list[bytes]) -> None:
        if self.plain:
            ids, size, plain, rest, tokenize = [], [], [], [], self.model.tokenize
            for w in words:
                letters = w.rstrip(MARKS)
                if letters.isalpha() and letters.islower():  # of bytes: a-z alone
                    before = len(ids)
                    ids += [t.id for t in tokenize(letters.decode())]
                    if len(letters) < len(w):
                        ids += [t.id for t in tokenize(w[len(letters):].decode())]
                    plain.append(w)
                    size.append(len(ids) - before)
                else:
                    rest.append(w)
            self._add(plain, np.array(size, np.int64), np.array(ids, np.uint32))
            words = rest
        e = self.tokenizer.encode([w.decode("utf-8", "replace") for w in words], is_pretokenized=True, add_special_tokens=False)
        size = np.bincount(np.array(e.word_ids, np.int64), minlength=len(words)) if len(e.ids) else np.zeros(len(words), np.int64)
        self._add(words, size, np.array(e.ids, np.uint32))

    def _add(self, words: list[bytes], size: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.place)
        first = int(self.ends[at])
        self.place.update(zip(words, range(at, at + len(words))))
        self.ends = _put(self.ends, at + 1, first + np.cumsum(size))
        self.ids = _put(self.ids, first, ids)

    def _places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Cache place of every word of all texts in a row, and the offsets where each text's words begin."""
        # the tokenizer lower-cases; A-Z may be so before, unless a text could hold one of its special strings
        lists = [(t if b"<|" in t else t.lower()).split() for t in texts]
        words = list(itertools.chain.from_iterable(lists))
        if len(self.place) > self.cache_words:
            self._reset()
        at = np.fromiter(map(self.place.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys([words[i] for i in new])))
            at[new] = [self.place[words[i]] for i in new]
        cuts = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=cuts[1:])
        return at, cuts

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Number of ids of each text."""
        at, cuts = self._places(texts)
        return np.diff(np.concatenate([[0], np.cumsum(self.ends[at + 1] - self.ends[at])])[cuts])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row, and the offsets where each text's ids begin."""
        at, cuts = self._places(texts)
        size = self.ends[at + 1] - self.ends[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(int(ends[-1])) - np.repeat(ends[:-1] - self.ends[at], size)]
        return ids, ends[cuts]


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str = VOCABULARY) -> WordEncoder:
    """The encoder of this Python worker, with the words that earlier tasks have met."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name)
    return _encoders[name]
