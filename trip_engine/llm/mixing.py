"""Operator 6: mixing sources to target weights by pivotal dependent rounding.

Native: DataFrame and SQL functions only.

The target of a source over its size is the copy rate of its documents; each
document gets the whole part of the rate, and the fraction is its probability of
one copy more. The fractions are rounded together, from the largest document
of a block to the smallest: each is paired with the pool of all smaller ones,
which share one probability. The two exchange *words* (probability times size)
in one of two directions until the document's probability is 0 or 1: up, to 1,
with just that probability, or down, so that both keep their expectation and
the expected words of the block stay what they were. A document the pool
cannot pay for in one direction goes the other way, without chance: its expectation is
given up for its source's words, which stay near the target (README has figures).
One the pool can neither pay for nor absorb stays open while the pool is decided. In
the end one document of a block is open, a small one as a rule.

Rows equal in id, source and text are one document with a count: as many of them
as their probabilities add up to get the copy, and only the fraction that is left takes part
in the exchange. So a row repeated a million times is one entry of a block.

The blocks form a reduction tree: documents are dealt by hash to bounded blocks
of a source, and the open documents of the blocks are dealt to fewer blocks on
the next level, where their residual words are paired again. Only the last open
document of a source is rounded by itself, to the nearer side. A source
with a third of all rows is just more blocks. Randomness comes from hashes of
the document, so reruns agree whatever the partitioning.

Defined cases: a null text has size 0 and takes 0 words; a null source is a
source of its own, after all others; of repeated rows some have the copy and the others
not; documents of equal size are paired in the order of their hashes, sources of equal cap per
weight in code point order; with no words at all every target is 0; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trip_engine.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK = 64                 # documents folded together, on average
SEED = 7
_WIDE = "decimal(38,0)"    # products of word counts and weights


def word_count(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*parts) -> str:
    """SQL of a number in (0, 1) that depends on the parts alone."""
    return f"((shiftrightunsigned(xxhash64({', '.join(parts)}), 11) + 0.5D) / 9007199254740992D)"


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, n_docs, target, rate per source, from (source, size) rows.

    Sources in code point order weigh 5, 2, 1, 5, ... and share all words in
    proportion, but none gets more than three times its own size; what is cut off is
    shared by weight among the others until nothing is above. The fixed point is
    a common level: target = min(weight * level, cap). A source is capped if
    the level of those with a larger cap per weight still lifts it to its cap.
    The windows run over one row per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    ranked = totals.withColumn("weight", F.element_at(
        weights, (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))) \
        .withColumn("cap", MAX_COPIES * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = ranked \
        .withColumn("total", F.sum("source_size").over(everything)) \
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("left_weight", F.sum("weight").over(onward)) \
        .withColumn("capped", F.col("cap").cast(_WIDE) * F.col("left_weight")
                    <= F.col("weight").cast(_WIDE) * F.col("left_words"))
    open_words = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * open_words).cast("double") / open_weight)
    return levels.withColumn("target", target).select(
        "source", "source_size", "n_docs", "target",
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
            F.col("target") / F.col("source_size")).alias("rate"))


_DOC = "struct<size: bigint, h: bigint, doc_id: bigint, p: double, rows: bigint, sure: bigint>"
_DONE = "struct<doc_id: bigint, h: bigint, size: bigint, extra: int, rows: bigint, sure: bigint>"
EQUAL_ROWS = 100_000       # above so many equal rows they are dealt out before they are listed
_EPS = "1e-9D"


def _fold() -> Column:
    """Folds the documents ``docs`` of a block, largest first; each has a size > 0
    and an open probability p. The state holds the undecided documents' size
    (``rest``) and expected words (``due``), the open document, if any, and the
    decided ones with ``extra`` 0 or 1."""
    p = "(s.due / s.rest)"  # the pool's and the document's probability
    up_can = "s.due >= d.size - 1e-6D"                # the pool can give what is missing to 1
    down_can = "s.due <= s.rest - d.size + 1e-6D"     # the pool can take all of it
    coin = _uniform("d.h", "d.doc_id", str(SEED))

    def decided(extra: str) -> str:
        return (f"named_struct('rest', s.rest - d.size, 'due', greatest(0D, s.due - d.size * {extra}), "
                f"'open', s.open, 'done', concat(s.done, array(named_struct("
                f"'doc_id', d.doc_id, 'h', d.h, 'size', d.size, 'extra', cast({extra} as int), "
                f"'rows', d.rows, 'sure', d.sure))))")

    def left_open(rest: str, due: str, p: str) -> str:
        return (f"named_struct('rest', {rest}, 'due', {due}, 'open', named_struct("
                f"'size', d.size, 'h', d.h, 'doc_id', d.doc_id, 'p', {p}, 'rows', d.rows, 'sure', d.sure), "
                f"'done', s.done)")

    pool = "cast(s.rest - d.size as double)"
    return F.expr(f"""
      aggregate(docs,
        named_struct('rest', aggregate(docs, 0L, (t, d) -> t + d.size),
                     'due', aggregate(docs, 0D, (t, d) -> t + d.size * d.p),
                     'open', cast(null as {_DOC}), 'done', cast(array() as array<{_DONE}>)),
        (s, d) -> CASE
          WHEN {p} <= {_EPS} THEN {decided("0")}
          WHEN {p} >= 1 - {_EPS} THEN {decided("1")}
          WHEN s.rest = d.size THEN {left_open("0L", "0D", p)}
          WHEN {up_can} AND {down_can} THEN IF({coin} < {p}, {decided("1")}, {decided("0")})
          WHEN {up_can} THEN {decided("1")}
          WHEN {down_can} THEN {decided("0")}
          ELSE {left_open("s.rest - d.size", pool, f"(s.due - {pool}) / d.size")} END)""")


def _round(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """(src, doc_id, h, size, extra, rows, sure): every document with size > 0 and an open
    fraction, rounded by the reduction tree; ``rows`` and ``sure`` are carried along."""
    most = sources.agg(F.max("n_docs")).first()[0] or 0
    level, blocks_of = 0, F.ceil(F.col("n_docs") / BLOCK).cast("long")
    decided = None
    while True:
        last = most <= BLOCK
        block = F.lit(0).cast("long") if last else F.pmod(
            F.xxhash64("h", "doc_id", F.lit(SEED + level)), blocks_of)
        folded = materialize(
            docs.withColumn("block", block).groupBy("src", "block", "n_docs")
            .agg(F.sort_array(F.collect_list(F.struct("size", "h", "doc_id", "p", "rows", "sure")), asc=False).alias("docs"))
            .select("src", "n_docs", _fold().alias("s")), "mix-level")
        done = folded.select("src", F.inline("s.done"))
        decided = done if decided is None else decided.unionByName(done)
        rest = folded.where("s.open IS NOT NULL").select("src", F.col("s.open").alias("o"), blocks_of.alias("n_docs")) \
            .select("src", "n_docs", "o.*")
        if last:
            nearest = (F.col("p") >= 0.5).cast("int")
            return decided.unionByName(rest.select(
                "src", "doc_id", "h", "size", nearest.alias("extra"), "rows", "sure"))
        docs, most, level = rest, -(-most // BLOCK), level + 1


def _listed(rounded: DataFrame, most: int) -> DataFrame:
    """(src, doc_id, h, size, extra): one row again for each of the equal rows."""
    last = F.col("rows") - 1
    parts = rounded.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / EQUAL_ROWS))))
    if most > EQUAL_ROWS:
        parts = parts.repartition("src", "doc_id", "h", "part")
    lo, hi = F.col("part") * EQUAL_ROWS, F.least(last, (F.col("part") + 1) * EQUAL_ROWS - 1)
    return parts.withColumn("i", F.explode(F.sequence(lo, hi))).select(
        "src", "doc_id", "h", "size", (F.col("i") < F.col("sure") + F.col("extra")).cast("int").alias("extra"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of id, source and text), source, size, source_size, target,
    copies (how often the mix takes the document): one row per document."""
    sized = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), document_hash().alias("h"),
        F.col("source").cast("string").alias("source"), word_count().alias("size")), "mix-sizes")
    sources = materialize(source_targets(sized), "mix-sources")
    # a short key per source: null-safe and equal in width for any source name
    keyed = sources.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    keyed = materialize(keyed, "mix-keys")
    joined = sized.join(keyed.withColumnRenamed("source", "k_source"),
                        F.col("source").eqNullSafe(F.col("k_source"))).drop("k_source")
    whole = F.floor("rate").cast("long")
    # equal rows are one document: ``sure`` of them get the copy, the rest of the sum is open
    equal = joined.where("size > 0").groupBy("src", "n_docs", "size", "h", "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("rate") - whole).alias("p"))
    due = F.col("rows") * F.col("p")
    equal = materialize(equal.withColumn("sure", F.floor(due + F.expr(_EPS)).cast("long"))
                        .withColumn("p", F.greatest(F.lit(0.0), due - F.col("sure"))), "mix-equal")
    rounded = _listed(_round(equal, keyed), equal.agg(F.max("rows")).first()[0] or 0)
    wordless = joined.where("size = 0").select("src", "doc_id", "h", "size", F.lit(0).alias("extra"))
    return rounded.unionByName(wordless).join(keyed, "src").select(
        "doc_id", "h", "source", "size", "source_size", "target",
        F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(whole + F.col("extra")).alias("copies"))


def document_hash() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                      F.coalesce(F.col("text"), F.lit("")))


def op6_mix_sources(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mixed documents, all columns, each as often as the
    mix takes it. Documents without words carry nothing and are left out; of
    rows equal in id, source and text, one stands for all their copies."""
    taken = materialize(mix(docs).groupBy("doc_id", "h").agg(
        F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")).where("__copies > 0")
        .select(F.col("doc_id").alias("__mix_id"), F.col("h").alias("__mix_h"), "__copies", "__rows"), "mix-taken")
    rows = docs.withColumn("__h", document_hash())
    if not taken.where("__rows > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__h"])  # their copies are counted together
    many = rows.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col("__mix_id"))
                     & (F.col("__h") == F.col("__mix_h")))
    return many.withColumn("__n", F.explode(F.expr("sequence(cast(1 as bigint), __copies)"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
