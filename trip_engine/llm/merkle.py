"""Operator 12: Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf, the hash of its fields. The leaves of a group (a language)
ascend by id; ``arity`` consecutive nodes at a time become their hash until
one is left, the group's root, and the group roots likewise become the root.

Leaves get exact positions by range partitions and their counts, and a block of
aligned ones is a partition of the tree: a bounded row of its own. Each block hashes
its own subtree. Then blocks exchange: in a round, aligned groups of ``fanout``
subtrees swap roots, and the blocks of a subtree share the work, so that block i
of one talks to block i of the others; every block hashes the ancestors itself,
redundantly, and keeps the siblings it met. After log(blocks) / log(fanout)
rounds each block holds its upper proof and the root, without a way down. A
subtree at the ragged edge has fewer blocks than its siblings; its blocks then
answer for several. The group roots go through the same exchange. At last each block
reads its leaves again, adds the siblings inside the block, and folds every
leaf (or a tampered one) up to the root.

Only digests are shuffled, about a hundred bytes a document; a round moves one row
a block, and its result is written, so a lost executor repeats a round at most.

Defined cases: a null field hashes as ``-``; a null id or group comes first; rows
that tie in group and id ascend by leaf digest (equal rows are neighbours, each
with a proof of its own); a lone leaf is its own root, with an empty proof; texts of
any length are hashed whole, as their bytes; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import materialize, prepare_workers
from trip_engine.llm.ranked import with_positions

TAMPER = 7                 # of so many ids, by CRC-32, one is tampered with
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FEW_GROUPS = 10_000        # group roots with proofs (a kilobyte each) that are broadcast
SALTS = 16                 # copies of each beyond that, as one group may have most blocks


def node_digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Shape(NamedTuple):
    """``arity`` nodes make one above; a block has ``levels`` levels, a round ``round_levels``."""

    arity: int = 2
    levels: int = 10
    round_levels: int = 4

    @property
    def block(self) -> int:
        """Leaves of a block."""
        return self.arity ** self.levels

    @property
    def fanout(self) -> int:
        """Subtrees that swap roots in a round."""
        return self.arity ** self.round_levels

    def height(self, n: int) -> int:
        """Levels above ``n`` leaves until one node is left."""
        levels = 0
        while n > 1:
            n, levels = -(-n // self.arity), levels + 1
        return levels

    def above(self, nodes: list[str], levels: int) -> list[list[str]]:
        """``nodes`` and the next ``levels`` levels above them."""
        out = [nodes]
        for _ in range(levels):
            below = out[-1]
            out.append([node_digest(below[i:i + self.arity]) for i in range(0, len(below), self.arity)])
        return out

    def steps(self, levels: list[list[str]], at: int) -> list[str]:
        """The siblings of node ``at`` of the lowest level, level by level up to
        below the top: those before it in its run, a slash, those after it."""
        out = []
        for level in levels[:-1]:
            first = at - at % self.arity
            out.append("".join(level[first:at]) + "/" + "".join(level[at + 1:first + self.arity]))
            at //= self.arity
        return out


def fold(digest: str, proof: list[str]) -> str:
    """The root that a leaf and the steps of its proof lead to (a step tells its side by
    the slash, so no position is needed)."""
    for step in proof:
        before, after = step.split("/")
        digest = node_digest([before, digest, after])
    return digest


def proof_digest(proof: list[str]) -> str:
    """The hash of all siblings, level by level, from left to right."""
    return node_digest([step.replace("/", "") for step in proof])


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in LEAF_FIELDS]), 256)


_NODE = "grp binary, block bigint, n bigint, node string, proof array<string>"


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      ["grp", "block", "n", "node", "proof"])


def _block_roots(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Each block's own subtree, hashed up to the block's root; the levels end where
    the whole group has one node left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _nodes([(grp, block, n, shape.above(leaves, min(shape.levels, shape.height(n)))[-1][0], [])
                          for grp, block, n, leaves in zip(*(b.column(i).to_pylist() for i in range(4)))])

    return blocks.select("grp", "block", "n", F.col("leaves.leaf").alias("leaves")).mapInArrow(run, _NODE)


def _exchange(blocks: DataFrame, number: int, shape: Shape) -> DataFrame:
    """One round: the ``fanout`` subtrees of an aligned group swap their roots, and
    every block hashes the ``round_levels`` levels above by itself."""
    done = shape.levels + number * shape.round_levels  # levels of the tree so far
    covers, size = shape.arity ** done, shape.fanout ** number  # leaves, blocks of a whole subtree
    nodes = F.expr(f"(n + {covers} - 1) div {covers}")  # subtrees of the group
    last_size = F.expr(f"(n + {shape.block} - 1) div {shape.block}") - (nodes - 1) * size
    at, slot = F.expr(f"block div {size}"), F.expr(f"block % {size}")
    # the blocks of a last, smaller subtree answer for the slots that they lack
    answers = F.when((at == nodes - 1) & (at % shape.fanout != 0) & (last_size < size),
                     F.sequence(slot, F.lit(size - 1).cast("long"), last_size)).otherwise(F.array(slot))
    sent = blocks.where(F.col("n") > covers).select(
        "grp", "n", F.expr(f"block div {size * shape.fanout}").alias("peers"), (at % shape.fanout).alias("pos"),
        "node", "block", slot.alias("own"), "proof", F.explode(answers).alias("slot"))
    member = F.struct("pos", "node", "block", F.when(F.col("own") == F.col("slot"), F.col("proof")).alias("proof"))
    # at most ``fanout`` rows each
    met = sent.groupBy("grp", "n", "peers", "slot").agg(F.sort_array(F.collect_list(member)).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for grp, n, members in zip(*(b.column(i).to_pylist() for i in range(3))):
                levels = shape.above([m["node"] for m in members], min(shape.round_levels, shape.height(n) - done))
                out.extend((grp, m["block"], n, levels[-1][0], m["proof"] + shape.steps(levels, m["pos"]))
                           for m in members if m["proof"] is not None)  # answers for others end here
            yield _nodes(out)

    return met.select("grp", "n", "members").mapInArrow(run, _NODE).unionByName(blocks.where(F.col("n") <= covers))


def upper_proofs(blocks: DataFrame, largest: int, name: str, shape: Shape) -> DataFrame:
    """grp, block, n, node (the group's root), proof (the block's upper proof)."""
    state, number = materialize(_block_roots(blocks, shape), f"{name}-roots"), 0
    while largest > shape.block * shape.fanout ** number:
        state = materialize(_exchange(state, number, shape), f"{name}-round{number}")
        number += 1
    return state


def _blocks(leaves: DataFrame, order: list[Column], name: str, shape: Shape) -> tuple[DataFrame, int]:
    """One written row per block: grp, block, n (leaves of the group), leaves (in order);
    and the size of the largest group. ``leaves`` has grp, leaf and what else it carries."""
    placed = with_positions(leaves, order, "grp", f"{name}-order", size="n")
    carried = [c for c in leaves.columns if c != "grp"]
    out = materialize(placed.groupBy("grp", F.expr(f"idx div {shape.block}").alias("block"), "n").agg(
        F.sort_array(F.collect_list(F.struct("idx", *carried))).alias("leaves")), f"{name}-blocks")
    return out, out.agg(F.max("n")).first()[0] or 0


def _proofs(leaves: list[dict], n: int, shape: Shape) -> Iterator[tuple[dict, list[str]]]:
    """The leaves of a block, each with its proof inside the block."""
    levels = shape.above([x["leaf"] for x in leaves], min(shape.levels, shape.height(n)))
    for x in leaves:
        yield x, shape.steps(levels, x["idx"] % shape.block)


def _folded(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Every leaf with its whole proof applied. ``blocks`` has leaves, the block's upper
    proof and the proof of its group's root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, leaves, upper, subroot, top, root in zip(*(b.column(i).to_pylist() for i in range(6))):
                rows = []
                for x, inner in _proofs(leaves, n, shape):
                    proof = inner + upper + top
                    rows.append((x["doc_id"], x["leaf"], proof_digest(proof), fold(x["tampered"] or x["leaf"], proof)))
                doc_id, leaf, digest, folded = zip(*rows)
                k = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, pa.int64()), pa.array(leaf, pa.string()), pa.array([subroot] * k, pa.string()),
                     pa.array([root] * k, pa.string()), pa.array(digest, pa.string()), pa.array(folded, pa.string())],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return blocks.select("n", "leaves", "upper", "subroot", "top", "root").mapInArrow(
        run, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def _top_proofs(blocks: DataFrame, shape: Shape) -> DataFrame:
    """grp, root and the proof of each group's root, from blocks of group roots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, leaves, root, upper in zip(*(b.column(i).to_pylist() for i in range(4))):
                found = [*_proofs(leaves, n, shape)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["key"] for x, _ in found], pa.binary()), pa.array([root] * len(found), pa.string()),
                     pa.array([p + upper for _, p in found], pa.list_(pa.string()))], ["grp", "root", "top"])

    return blocks.select("n", "leaves", "root", "proof").mapInArrow(run, "grp binary, root string, top array<string>")


def manifest(docs: DataFrame, tamper: int = TAMPER, shape: Shape = Shape()) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per document.
    One id in ``tamper`` folds a leaf whose n_chars has changed."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                       F.col("n_chars").cast("long").alias("n_chars"), "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper == 0
    # a group's key: null first, then the language's bytes
    grp = F.coalesce(F.concat(F.lit(b"\x01"), F.col("lang").cast("string").cast("binary")), F.lit(b"\x00"))
    leaves = materialize(rows.select(
        grp.alias("grp"), "doc_id", leaf_digest().alias("leaf"),
        F.when(hit, leaf_digest(n_chars=F.col("n_chars") + 1)).alias("tampered")), "merkle-leaves")
    blocks, largest = _blocks(leaves, [F.col("grp"), F.col("doc_id"), F.col("leaf")], "merkle", shape)
    upper = upper_proofs(blocks, largest, "merkle", shape)
    # the group roots are the leaves of one more tree
    groups = materialize(upper.where("block = 0").select(
        F.lit(b"").alias("grp"), F.col("grp").alias("key"), F.col("node").alias("leaf")), "merkle-groups")
    top_blocks, many = _blocks(groups, [F.col("grp"), F.col("key")], "merkle-top", shape)
    tops = upper_proofs(top_blocks, many, "merkle-top", shape).select("block", F.col("node").alias("root"), "proof")
    top = _top_proofs(top_blocks.join(tops, "block"), shape)
    whole = blocks.join(upper.select("grp", "block", F.col("node").alias("subroot"), F.col("proof").alias("upper")),
                        ["grp", "block"])
    if many <= FEW_GROUPS:
        whole = whole.join(F.broadcast(top), "grp")
    else:
        copies = top.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        whole = whole.withColumn("salt", F.col("block") % SALTS).join(copies, ["grp", "salt"])
    return _folded(whole, shape).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(docs: DataFrame) -> DataFrame:
    return manifest(docs)
