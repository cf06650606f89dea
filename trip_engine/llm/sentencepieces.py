"""Operator 11: SentencePiece encoding and decoding by a score-ordered agenda.

For merge-type vocabularies. The symbols of a text (its characters, white space
as the mark U+2581) form a linked list; an agenda holds every pair of
neighbours that is a piece, ordered by the piece's score and, for equal scores,
by position. The best pair is merged, its new neighbours join the agenda, and
entries whose symbols have changed since are skipped: n log n steps for n symbols,
however long a word is. What is no piece in the end falls back to its bytes.

No piece of such a vocabulary has the mark behind another character (this is checked
when the model is read; otherwise texts are not cut), so no merge crosses the place
before a mark: texts are cut there, and the ids of short parts are kept in a
bounded cache. Ids are decoded from the whole list by joining their
surfaces; runs of byte ids are read as UTF-8, with U+FFFD for each byte that
is none.

Each Arrow batch is checked against the sentencepiece library: all parts that the batch met
for the first time, in one call (a part stands behind a line end then, which nothing
merges with), and the batch's longest text as a whole, ids and decoded text alike.
``agrees`` is false for a text with a part that the library encodes otherwise
(``check=False`` leaves the check out, ``agrees`` is then null).

Models with a normalizer other than identity, with user-defined or unused pieces,
without byte fallback, or of another type are refused.

Defined cases: null counts as an empty text with no ids; texts of any length are
encoded whole; bytes that are not UTF-8 count as U+FFFD; pairs of equal score merge
from the left; repeated rows come back each; an empty table gives an empty result;
other columns are ignored, whatever their names. One narrow pass, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import paused_gc, prepare_workers, utf8

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHE = 400_000            # parts a worker remembers, twice
LONGEST = 48               # characters of a remembered part
BAD = "�"
# fixed values: kinds of pieces and fields of the public model format
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message in the wire format of the model file."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class PieceModel:
    """Pieces, scores and settings of a model file."""

    _made: dict[tuple[str, bool], PieceModel] = {}

    @classmethod
    def of(cls, name: str, check: bool = True) -> PieceModel:
        """One for each worker; what has been learnt without a check is kept apart."""
        if (name, check) not in cls._made:
            cls._made[name, check] = cls(name)
        return cls._made[name, check]

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece
        path = public_tokenizers.path(name)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            parts = [*_fields(f.read())]
        trainer = dict(_fields(next(v for n, v in parts if n == 2)))
        normal = dict(_fields(next(v for n, v in parts if n == 3)))
        kinds = [dict(_fields(v)).get(3, NORMAL) for n, v in parts if n == 1]
        if trainer.get(3) != MERGE_TYPE or not trainer.get(35):
            raise ValueError(f"{name}: not a merge-type vocabulary with byte fallback")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or trainer.get(24):
            raise ValueError(f"{name}: only identity normalization with marks before words")
        if not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{name}: user-defined or unused pieces")
        self.prefix = MARK if normal.get(3, 1) else ""
        names = [self.library.id_to_piece(i) for i in range(len(kinds))]
        self.rank: dict[str, float] = {}   # lower merges first
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.value: dict[int, int] = {}    # byte by id
        self.surface: list[str] = []
        self.unknown: set[int] = set()
        self.control: set[int] = set()
        for i, (piece, kind) in enumerate(zip(names, kinds)):
            self.surface.append(piece.replace(MARK, " ") if kind == NORMAL else "")
            if kind == NORMAL:
                self.rank[piece], self.id[piece] = -self.library.get_score(i), i
            elif kind == BYTE:
                self.byte[int(piece[3:5], 16)] = i
                self.value[i] = int(piece[3:5], 16)
            elif kind == UNKNOWN:
                self.unknown.add(i)
                self.surface[i] = trainer[44].decode() if 44 in trainer else " ⁇ "
            else:
                self.control.add(i)
        self.named = [str(i) for i in range(len(names))]
        self.joined = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        crossing = any(MARK in p.lstrip(MARK) for p in self.id)
        self.cut = None if crossing else re.compile(self._cuts()).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.fresh: dict[str, tuple[int, ...]] = {}  # learnt since the last check
        self.wrong: set[str] = set()                 # parts the library encodes otherwise
        self.lead = [*self._ids(self.prefix), *self._ids("\n")]
        self.by_part = "\n" not in set().union(*self.joined) and self.cut is not None

    def _cuts(self) -> str:
        """A pattern for parts that no merge leaves: from mark to mark, characters that are
        in no longer piece (line ends), and a word's letters apart from a sign that no piece
        has behind a letter."""
        plain = [chr(c) for c in range(128) if not chr(c).isalnum()]
        behind = {b for a, b in self.joined if a.isalpha()}
        inside = set().union(*self.joined)
        signs = "".join(re.escape(c) for c in plain if c not in behind)
        alone = "".join(re.escape(c) for c in plain if c not in inside)
        word = rf"{MARK}*[^\W\d_]+(?=[{signs}{MARK}])|" if signs else ""
        single = f"[{alone}]|" if alone else ""
        return f"{word}{single}{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+"

    # --- encoding -------------------------------------------------------------
    def merge(self, text: str) -> list[str]:
        """The symbols that are left when no pair of neighbours is a piece."""
        symbols, score = list(text), self.rank.get
        n = len(symbols)
        before, after = [*range(-1, n - 1)], [*range(1, n), -1]
        # (score, left place, right place, length of the pair), best first
        agenda = [(s, i, i + 1, 2) for i, pair in enumerate(zip(symbols, symbols[1:]))
                  if (s := score(pair[0] + pair[1])) is not None]
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of them has been merged with another since
            symbols[left] = merged = a + b
            symbols[right] = ""
            after[left] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = left
                pair = merged + symbols[beyond]
                if (s := score(pair)) is not None:
                    heappush(agenda, (s, left, beyond, len(pair)))
            earlier = before[left]
            if earlier >= 0:
                pair = symbols[earlier] + merged
                if (s := score(pair)) is not None:
                    heappush(agenda, (s, earlier, left, len(pair)))
        return [*filter(None, symbols)]

    def _ids(self, part: str) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in self.merge(part):
            i = self.id.get(symbol)
            if i is None:
                out.extend(self.byte[b] for b in symbol.encode("utf-8"))
            else:
                out.append(i)
        return tuple(out)

    def _learn(self, part: str) -> tuple[int, ...]:
        """The ids of a part that is not in the cache: cut once more between characters that no
        piece has side by side, which no merge crosses either. Short ones are kept; a full
        cache becomes the older one, whose parts come back when they are met again."""
        ids = self.older.get(part)
        if ids is None:
            joined = self.joined
            cuts = [i for i in range(1, len(part)) if part[i - 1:i + 1] not in joined]
            if cuts:
                small = [part[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(part)])]
                ids = tuple(chain.from_iterable([self.known.get(x) or self._learn(x) for x in small]))
            else:
                ids = self._ids(part)
            self.fresh[part] = ids
        if len(part) <= LONGEST:
            if len(self.known) >= CACHE:
                self.known, self.older = {}, self.known
            self.known[part] = ids
        return ids

    def parts(self, text: str) -> list[str]:
        marked = self.prefix + text.replace(" ", MARK) if text else ""
        return self.cut(marked) if self.cut else [marked] if marked else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            parts = self.parts(text)
            ids = [*map(self.known.get, parts)]
            if None in ids:
                ids = [(self.known.get(p) or self._learn(p)) if i is None else i for p, i in zip(parts, ids)]
            out.append([*chain.from_iterable(ids)])
        return out

    # --- decoding -------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """The text of any list of ids; control ids are silent, and the mark that
        encoding puts in front goes."""
        surface, value = self.surface, self.value
        if value.keys().isdisjoint(ids):
            text = "".join(map(surface.__getitem__, ids))
        else:
            out: list[str] = []
            run = bytearray()
            for i in ids:
                byte = value.get(i)
                if byte is not None:
                    run.append(byte)
                    continue
                if run:
                    out.append(_utf8(bytes(run)))
                    run.clear()
                out.append(surface[i])
            if run:
                out.append(_utf8(bytes(run)))
            text = "".join(out)
        if self.prefix and text.startswith(" "):
            first = next(i for i in ids if i not in self.control)
            if first not in self.value and first not in self.unknown:
                return text[1:]
        return text

    def agrees(self, texts: list[str], ids: list[list[int]], decoded: list[str]) -> list[bool]:
        """Whether the library finds the same ids and the same decoded text."""
        theirs = self.library.encode(texts, num_threads=1)
        return [a == b and c == d for a, b, c, d in
                zip(ids, theirs, decoded, self.library.decode(theirs, num_threads=1))]

    def check(self, texts: list[str], ids: list[list[int]], decoded: list[str]) -> list[bool]:
        """``agrees`` for a batch, text by text, from the parts that are new since the last check
        and the longest text."""
        if not texts or not self.by_part:
            return self.agrees(texts, ids, decoded)
        parts, found = [*self.fresh], [[*self.lead, *x] for x in self.fresh.values()]
        self.fresh = {}
        right = self.agrees(["\n" + p.replace(MARK, " ") for p in parts], found, [*map(self.decode, found)])
        self.wrong.update(p for p, ok in zip(parts, right) if not ok)
        i = max(range(len(texts)), key=lambda i: len(texts[i]))
        whole = self.agrees([texts[i]], [ids[i]], [decoded[i]])[0]
        out = [not self.wrong or self.wrong.isdisjoint(self.parts(t)) for t in texts]
        out[i] = out[i] and whole
        return out


def _utf8(run: bytes) -> str:
    """A run of bytes as text: whole characters, and U+FFFD for each other byte."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(BAD)
            size = 1
        at += size
    return "".join(out)


RESULT = "doc_id bigint, ids array<int>, decoded string, agrees boolean"
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean"


def _encoded(batches: Iterable[pa.RecordBatch], model: str, check: bool):
    pieces = PieceModel.of(model, check)
    for b in batches:
        texts = [x.decode("utf-8", "replace") for x in b.column(1).to_pylist()]
        with paused_gc():
            ids = pieces.encode(texts)
        decoded = [pieces.decode(x) for x in ids]
        agrees = pieces.check(texts, ids, decoded) if check else [None] * len(ids)
        pieces.fresh = {}
        yield pieces, b.column(0), ids, decoded, pa.array(agrees, pa.bool_())


def _rows(docs: DataFrame) -> DataFrame:
    prepare_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data"))


def encode_documents(docs: DataFrame, model: str = MODEL, check: bool = True) -> DataFrame:
    """doc_id, ids, decoded, agrees: one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc_id, ids, decoded, agrees in _encoded(batches, model, check):
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), agrees],
                ["doc_id", "ids", "decoded", "agrees"])

    return _rows(docs).mapInArrow(run, RESULT)


def encode_digests(docs: DataFrame, model: str = MODEL, check: bool = True) -> DataFrame:
    """As ``encode_documents``, with the number and digests of ids and text in place
    of themselves (which then never leave the Python worker)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces, doc_id, ids, decoded, agrees in _encoded(batches, model, check):
            name = pieces.named.__getitem__
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array([*map(len, ids)], pa.int64()),
                 pa.array([sha256(",".join(map(name, x)).encode()).hexdigest() for x in ids], pa.string()),
                 pa.array([sha256(x.encode()).hexdigest() for x in decoded], pa.string()), agrees],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"])

    return _rows(docs).mapInArrow(run, DIGEST)


def op11_sentencepiece(docs: DataFrame) -> DataFrame:
    return encode_digests(docs)
