"""Operator 9: vector bin packing by the dot-product heuristic.

An example is a vector (tokens, segments, loss-bearing tokens); a sequence has
a limit on each. The packer holds a bounded pool of examples. For the open
sequence it takes, among the examples that fit, the one with the largest dot
product of its vector and the remaining capacity (both as shares of the
limits); when none fits, the sequence is closed - or, where cutting is allowed,
filled up to the brim with a piece of the example that leaves the least rest.
What remains at the end of a partition is cut into sequences whose lengths are
powers of two, which need no padding.

Every task packs the rows of its own input partition, so nothing is shuffled and
nothing is gathered; a partition pays for its last few sequences only. The
rows of a task depend only on its input split, so a retried task writes
the same sequences.

Defined cases: a null text counts as empty and is one piece with the end
token alone; repeated rows are packed as often as they occur; an example larger
than a limit gets a sequence of its own where cutting is not allowed; a very
long text is cut into full sequences and a rest; of equal dot products the example that
stands first in the pool is taken; bytes that are not UTF-8 raise; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, utf8
from trip_engine.llm.tokenizing import WordTokenizer

MAX_TOKENS = 4096
MAX_SEGMENTS = 256         # of instruction data; a document's piece has a token at least, so that
MAX_LOSS = 4096            # the token limit alone binds for documents
POOL = 256
END = 2
TOKENIZER = "word_bpe_49k.json"
PIECES = ("doc_id bigint, start bigint, length bigint, loss bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class Example:
    """``ids``: little-endian unsigned 32-bit token ids; the last ``loss`` of
    them bear loss (an answer follows its prompt)."""

    __slots__ = ("doc_id", "ids", "n", "loss", "total", "start")

    def __init__(self, doc_id, ids: bytes, loss: int | None = None, total: int | None = None, start: int = 0):
        self.doc_id, self.ids, self.n = doc_id, ids, len(ids) // 4
        self.loss = self.n if loss is None else loss
        self.total = self.n if total is None else total
        self.start = start

    def cut(self, n: int) -> tuple[Example, Example]:
        quiet = self.n - self.loss
        head = max(0, n - quiet)
        return (Example(self.doc_id, self.ids[:4 * n], head, self.total, self.start),
                Example(self.doc_id, self.ids[4 * n:], self.loss - head, self.total, self.start + n))


class Packer:
    def __init__(self, limits=(MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS), cut: bool = True, pool: int = POOL):
        self.limits = np.array(limits, float)
        self.cut, self.size = cut, pool
        self.pool: list[Example] = []
        self.need = np.zeros((pool, 3))
        self.open: list[Example] = []
        self.left = self.limits.copy()

    def add(self, e: Example) -> Iterator[list[Example]]:
        """Takes an example; yields the sequences that are complete by then."""
        if self.cut:
            while e.n > self.limits[0]:  # a long text: full sequences, then the rest
                head, e = e.cut(int(min(self.limits[0], self._reach(e, self.limits[2]))))
                yield [head]
        elif e.n > self.limits[0] or e.loss > self.limits[2]:
            yield [e]
            return
        self.need[len(self.pool)] = (e.n, 1, e.loss)
        self.pool.append(e)
        while len(self.pool) == self.size:
            yield from self._place()

    @staticmethod
    def _reach(e: Example, loss: float) -> float:
        """The longest head of ``e`` that bears at most ``loss``."""
        return e.n if e.loss <= loss else e.n - e.loss + loss

    def _take(self, i: int) -> Example:
        e, last = self.pool[i], self.pool.pop()
        if i < len(self.pool):
            self.pool[i] = last
            self.need[i] = self.need[len(self.pool)]
        return e

    def _put(self, e: Example) -> None:
        self.open.append(e)
        self.left -= (e.n, 1, e.loss)

    def _close(self) -> list[Example]:
        done, self.open, self.left = self.open, [], self.limits.copy()
        return done

    def _place(self) -> Iterator[list[Example]]:
        """Places one example of the pool, or closes the open sequence."""
        need = self.need[:len(self.pool)]
        fits = (need <= self.left).all(axis=1)
        if fits.any():
            score = (need / self.limits) @ (self.left / self.limits)
            score[~fits] = -1
            best = int(score.argmax())
            if self.cut and self.left[1] == 1 and need[best, 0] < self.left[0] and not fits.all():
                pass  # the last segment: a longer example fills it up
            else:
                self._put(self._take(best))
                if self.left[0] == 0 or self.left[1] == 0:
                    yield self._close()
                return
        if self.cut and self.left[0] > 0 and self.left[1] >= 1:
            reach = np.minimum(np.minimum(need[:, 0], self.left[0]),
                               np.where(need[:, 2] <= self.left[2], need[:, 0],
                                        need[:, 0] - need[:, 2] + self.left[2]))
            i = int((reach * 8192 - need[:, 0]).argmax())  # fills most, leaves the least rest
            if reach[i] >= 1:
                e = self._take(i)
                head, rest = e.cut(int(reach[i])) if reach[i] < e.n else (e, None)
                self._put(head)
                if rest is not None:
                    self.need[len(self.pool)] = (rest.n, 1, rest.loss)
                    self.pool.append(rest)
        if self.open:
            yield self._close()

    def finish(self) -> Iterator[list[Example]]:
        while self.pool:
            yield from self._place()
        if self.open and not self.cut:
            yield self._close()
        while self.open:  # the last sequence: lengths that are powers of two
            total = sum(e.n for e in self.open)
            want = 1 << (total.bit_length() - 1)
            part: list[Example] = []
            while want:
                e = self.open.pop(0)
                if e.n > want:
                    e, rest = e.cut(want)
                    self.open.insert(0, rest)
                part.append(e)
                want -= e.n
            yield part


def _rows(sequences: Iterator[list[Example]], first: int, have: int) -> Iterator[tuple]:
    for k, sequence in enumerate(sequences):
        offset = 0
        for e in sequence:
            yield (e.doc_id, e.start, e.n, e.loss, e.ids, e.total, first + have + k, offset)
            offset += e.n


def pack(rows: DataFrame, read: Callable[[pa.RecordBatch], Iterator[Example]],
         limits=(MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS), cut: bool = True) -> DataFrame:
    """The pieces of all examples that ``read`` makes of the rows, with their
    ids (see ``PIECES``). ``sequence_id`` holds the partition in its upper bits."""
    prepare_workers(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut)
        first, made = TaskContext.get().partitionId() << 36, 0
        schema = pa.schema([(n, pa.binary() if t == "binary" else pa.int64())
                            for n, t in (f.split() for f in PIECES.split(", "))])

        def batch(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        out: list[tuple] = []
        for b in batches:
            for example in read(b):
                for sequence in packer.add(example):
                    out.extend(_rows(iter([sequence]), first, made))
                    made += 1
                if len(out) >= 4096:
                    yield batch(out)
                    out = []
        for sequence in packer.finish():
            out.extend(_rows(iter([sequence]), first, made))
            made += 1
        if out:
            yield batch(out)

    return rows.mapInArrow(run, PIECES)


def document_reader(tokenizer: str = TOKENIZER, end: int = END):
    """Documents (doc_id, data) as examples that bear loss on every token."""
    def read(b: pa.RecordBatch) -> Iterator[Example]:
        words = WordTokenizer.of(tokenizer)
        tail = end.to_bytes(4, "little")
        for doc_id, ids in zip(b.column(0).to_pylist(), words.encode(b.column(1).to_pylist())):
            yield Example(doc_id, ids + tail)
    return read


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    return pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data")),
                document_reader(tokenizer), limits=(MAX_TOKENS, MAX_TOKENS, MAX_LOSS))


def op9_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                       "doc_tokens", "sequence_id", "offset")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the packed pieces with their token ids."""
    return pack_documents(docs).drop("loss").withColumn("ids_crc32", F.crc32("ids"))
