"""Operator 8: token counts by rank-synchronous array merging.

Byte-level BPE over many pre-tokens at once: their symbols lie end to end in
one numpy array with the number of their sequence beside them (ragged rows).
In every step each sequence looks up the ranks of its neighbouring pairs,
finds its own lowest rank, and applies that pair at all its places together
(from the left, without overlaps); sequences without a known pair leave with
the number of symbols they have left. A pair's product is always younger than the
pair, so no lower rank can appear between equal ones, and the result is that
of merging one pair at a time.

A text is cut at single spaces between words; each piece is pre-tokenized once
and kept in a bounded cache of counts, as pieces repeat. Texts with two white
space characters in a row are pre-tokenized as a whole. Special strings are one
token each, as in the library's default.

Defined cases: null counts as an empty text with 0 bytes and 0 tokens;
repeated rows are counted each; texts of any length are counted whole (one unbroken word is
ranked anew in every step, quadratic in its length); bytes that are not UTF-8 raise; an
empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, utf8

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CACHE = 600_000            # pieces, and as many pre-tokens, a worker remembers
AT_ONCE = 1 << 16          # pre-tokens merged together
NONE = np.int64(1 << 40)
# fixed value: the pre-tokenization pattern of byte-level BPE
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_DOUBLE = re.compile(r"\s\s")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class RankMerger:
    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.base = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        codes = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], order.astype(np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.width + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols survive in each of the words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.minimum(sizes, 1)
        symbols = self.base[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            rank[:-1] = self._rank(symbols[:-1], symbols[1:])
            rank[:-1][owner[:-1] != owner[1:]] = NONE
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[first, len(symbols)])
            lowest = np.minimum.reduceat(rank, first)
            over = lowest == NONE
            out[owner[first[over]]] = lengths[over]
            hit = (rank == np.repeat(lowest, lengths)) & (rank < NONE)
            at = np.flatnonzero(hit)
            # of touching places (the same symbol again and again) every other one
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1]) if len(at) else at
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[place % 2 == 0]
            symbols[at] = self.product[rank[at]]
            stay = ~np.repeat(over, lengths)
            stay[at + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return out


class TokenCounter:
    _made: dict[str, TokenCounter] = {}

    @classmethod
    def of(cls, name: str) -> TokenCounter:
        if name not in cls._made:
            cls._made[name] = cls(name)
        return cls._made[name]

    def __init__(self, name: str):
        import public_tokenizers
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            spec = json.load(f)
        self.merger = RankMerger(spec["model"]["vocab"], spec["model"]["merges"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.split = regex.compile(PATTERN).findall
        self.pieces: dict[str, int] = {}
        self.tokens: dict[str, int] = {}

    def _learn(self, pieces: set[str]) -> None:
        if len(self.pieces) + len(pieces) > CACHE:
            self.pieces.clear()
        new = {p: self.split(p) for p in pieces.difference(self.pieces)}
        seen = set().union(*new.values())
        if len(self.tokens) + len(seen) > CACHE:
            self.tokens.clear()
        fresh = [*(seen.difference(self.tokens))]
        for lo in range(0, len(fresh), AT_ONCE):
            part = fresh[lo:lo + AT_ONCE]
            counted = self.merger.counts([x.encode("utf-8") for x in part]).tolist()
            self.tokens.update(zip(part, counted))
        get = self.tokens.__getitem__
        for p, parts in new.items():
            self.pieces[p] = sum(map(get, parts))

    def _cut(self, text: str) -> list[str]:
        """Pieces that are pre-tokenized apart; each but the first of a run keeps
        the space before it."""
        if _DOUBLE.search(text):
            return self.split(text)
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.split(text)

    def count(self, texts: list[str]) -> list[int]:
        cut, specials = [], []
        for t in texts:
            parts = [t] if self.special is None or "<" not in t else self.special.split(t)
            specials.append(len(parts) - 1)
            cut.append([p for part in parts if part for p in self._cut(part)])
        self._learn(set().union(*cut))
        get = self.pieces.__getitem__
        return [sum(map(get, pieces)) + extra for pieces, extra in zip(cut, specials)]


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per document, one narrow pass."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.of(tokenizer)
        for b in batches:
            data = b.column(1).to_pylist()
            counts = counter.count([x.decode("utf-8") for x in data])
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(x) for x in data], pa.int64()),
                pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data")) \
        .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(docs: DataFrame) -> DataFrame:
    return count_tokens(docs)
