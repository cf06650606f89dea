"""Token ids of whole texts by a public tokenizer, with a cache of words.

The word tokenizer drops white space and never lets a token span it, so a text
is the sequence of its words' tokens. Words are looked up in a bounded
cache; the library encodes those it has not seen. A worker process keeps the
cache over its tasks."""

from __future__ import annotations

import os

import numpy as np

from trip_engine.llm.common import paused_gc

CACHE_WORDS = 1_000_000
_LETTERS = frozenset(range(65, 91)) | frozenset(range(97, 123))
_MARKS = bytes(c for c in range(128) if not chr(c).isalnum() and c != 39)  # 39: apostrophe


class WordTokenizer:
    _made: dict[str, WordTokenizer] = {}

    @classmethod
    def of(cls, name: str) -> WordTokenizer:
        if name not in cls._made:
            cls._made[name] = cls(name)
        return cls._made[name]

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.words: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8") for w in words]
        for w, e in zip(words, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            self.words[w] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, new: set[bytes]) -> None:
        """Fills the cache for all of ``new``, which it lacks. A word that ends in a letter and a
        mark is its two parts: the tokenizer splits there."""
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
        parts = {}
        for w in new:
            head = w.rstrip(_MARKS)
            if len(head) < len(w) and head and head[-1] in _LETTERS and b"<|" not in w:
                parts[w] = head, w[len(head):]
        plain = {x for p in parts.values() for x in p} | (new.difference(parts))
        self._encode([*(plain.difference(self.words))])
        for w, (head, mark) in parts.items():
            self.words[w] = self.words[head] + self.words[mark]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Per text the ids as little-endian unsigned 32-bit numbers. Every word is looked
        up once; those that the cache lacks are learnt together."""
        with paused_gc():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[bytes]) -> list[bytes]:
        # the tokenizer lowers all letters itself; lowering A-Z before saves words,
        # but would hide the special strings' exact spelling
        get = self.words.get
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        found = [[*map(get, words)] for words in split]
        holes = [(words, ids, at) for words, ids in zip(split, found) if None in ids for at in _holes(ids)]
        self._learn({words[at] for words, _, at in holes})
        for words, ids, at in holes:
            ids[at] = get(words[at])
        return [*map(b"".join, found)]


def _holes(ids: list[bytes | None]) -> list[int]:
    out, at = [], -1
    for _ in range(ids.count(None)):
        at = ids.index(None, at + 1)
        out.append(at)
    return out
