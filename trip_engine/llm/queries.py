"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from trip_engine.llm import (
    cotraining,
    exact_dedup,
    html_tree,
    importance,
    langid,
    merkle,
    mixing,
    packing,
    quality_rules,
    sentencepieces,
    simhash,
    token_counts,
    toxicity,
)
from trip_engine.llm.common import read_table

_W = r"'[^\x20\x09-\x0D]+'"


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.op4_exact_dedup(read_table(spark, sf_dir, "documents"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWERED} AS t FROM documents)"""


def op7_quality_rules(spark, sf_dir):
    return quality_rules.op7_quality_rules(read_table(spark, sf_dir, "documents"))


# the same ranges as in ``quality_rules``, for a class of DuckDB's patterns
_UNSPACED = "".join(rf"\x{{{a}}}-\x{{{b}}}" for a, b in (
    ("E00", "FFF"), ("1000", "109F"), ("1780", "17FF"), ("3000", "30FF"), ("3400", "4DBF"), ("4E00", "9FFF"),
    ("F900", "FAFF"), ("FF00", "FFEF"), ("20000", "3FFFF")))


def _rules_sql() -> str:
    qr = quality_rules
    bits = " + ".join(f"CASE WHEN {r} THEN {1 << i} ELSE 0 END" for i, r in enumerate(qr.ALL_RULES.values()))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT rid, regexp_extract_all(t, {_W}) AS ws FROM d)),
g AS (SELECT rid, i, CASE WHEN lead(w, 4) OVER p IS NOT NULL THEN
             w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p
             || ' ' || lead(w, 4) OVER p END AS k
      FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g WHERE k IS NOT NULL) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, {_W}) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY rid),
m AS (SELECT d.doc_id, coalesce(s.n_words, 0)::BIGINT AS n_words, coalesce(s.word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             coalesce(l.n_lines, 0)::BIGINT AS n_lines, coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper,
             length(regexp_replace(t, '[^a-z]+', '', 'g'))::BIGINT AS n_lower,
             length(regexp_replace(t, '[^{_UNSPACED}]+', '', 'g'))::BIGINT AS n_unspaced,
             length(regexp_replace(t, '[\\x00-\\x7F]+|[^\\p{{L}}\\p{{Nl}}\\p{{No}}]+', '', 'g'))::BIGINT AS n_other_letters
      FROM d LEFT JOIN s USING (rid) LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
f AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {qr.mask_of(qr.BASE)}) <> 0 AS base_failed,
       (fail_bits & {qr.mask_of(qr.POLICIES[qr.CURRENT])}) = 0 AS kept,
       (fail_bits & {qr.mask_of(qr.POLICIES["v2"])}) = 0 AS kept_v2, fail_bits
FROM f"""


def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.op10_simhash_near_dedup(read_table(spark, sf_dir, "documents"))


def op6_mix_sources(spark, sf_dir):
    return mixing.op6_mix_sources(read_table(spark, sf_dir, "documents"))


def op9_packing(spark, sf_dir):
    return packing.op9_packing(read_table(spark, sf_dir, "documents"))


def op1_html_extraction(spark, sf_dir):
    return html_tree.op1_html_extraction(read_table(spark, sf_dir, "pages"))


def op2_toxicity(spark, sf_dir):
    return toxicity.op2_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_language_id(spark, sf_dir):
    return langid.op3_language_id(read_table(spark, sf_dir, "documents"))


def op5_quality_cotraining(spark, sf_dir):
    return cotraining.op5_quality_cotraining(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_token_counts(spark, sf_dir):
    return token_counts.op8_token_counts(read_table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark, sf_dir):
    return sentencepieces.op11_sentencepiece(read_table(spark, sf_dir, "documents"))


# CRC-32 of a text's UTF-8 bytes, by a table of 256 remainders
_CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY b) AS crc_of FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b)))"""


def _crc_sql(text: str) -> str:
    code = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, length({code}) // 2),
                                                      lambda i: ('0x' || substr({code}, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])))"""


def op12_merkle_manifest(spark, sf_dir):
    return merkle.op12_merkle_manifest(read_table(spark, sf_dir, "documents"))


def _manifest_sql() -> str:
    def digest(n_chars: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", n_chars, "text"]
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')" for c in fields) + ")"

    above = "list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))"
    step = ("CASE WHEN ({at} >> lvl) & 1 = 1 THEN 'L' || nodes[({at} >> lvl)] "
            "ELSE 'R' || coalesce(nodes[({at} >> lvl) + 2], '') END")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
l AS (SELECT doc_id, lang, {digest("n_chars::VARCHAR")} AS leaf,
             CASE WHEN {_crc_sql("doc_id::VARCHAR")} % {merkle.TAMPER} = 0
                  THEN {digest("(n_chars + 1)::VARCHAR")} END AS tampered
      FROM documents, crc_table),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             row_number() OVER () AS rid FROM l),
tree AS (SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY lang
         UNION ALL SELECT lang, lvl + 1, {above} FROM tree WHERE len(nodes) > 1),
subs AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
         FROM tree WHERE len(nodes) = 1),
top AS (SELECT 0 AS lvl, list(subroot ORDER BY pos) AS nodes FROM subs
        UNION ALL SELECT lvl + 1, {above} FROM top WHERE len(nodes) > 1),
steps AS (
  SELECT rid, 0 AS part, lvl, {step.format(at="pos")} AS step
  FROM p JOIN tree t ON p.lang IS NOT DISTINCT FROM t.lang WHERE len(nodes) > 1
  UNION ALL SELECT rid, 1, lvl, {step.format(at="s.pos")}
  FROM p JOIN subs s ON p.lang IS NOT DISTINCT FROM s.lang, top WHERE len(nodes) > 1),
proofs AS (SELECT rid, list(step ORDER BY part, lvl) AS steps,
                  string_agg(substr(step, 2), '' ORDER BY part, lvl) AS siblings FROM steps GROUP BY rid),
f AS (SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
             sha256(coalesce(siblings, '')) AS proof_sha256,
             list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda h, x:
               CASE WHEN x[1] = 'L' THEN sha256(substr(x, 2) || h) ELSE sha256(h || substr(x, 2)) END) AS folded_root
      FROM p JOIN subs s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN proofs USING (rid))
SELECT *, folded_root = root AS verified FROM f"""


def op13_importance_resampling(spark, sf_dir):
    return importance.op13_importance_resampling(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _resampling_sql() -> str:
    im = importance
    return f"""
WITH {_CRC_TABLE},
d AS (SELECT 0 AS side, row_number() OVER () AS rid, doc_id, text FROM documents
      UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
w AS (SELECT side, rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT side, rid, regexp_extract_all({_LOWERED}, '{im.WORD}') AS ws FROM d)),
f AS (SELECT side, rid, w AS f FROM w UNION ALL
      SELECT side, rid, f FROM (SELECT side, rid, w || ' ' || lead(w) OVER (PARTITION BY side, rid ORDER BY i) AS f
                                FROM w) WHERE f IS NOT NULL),
k AS (SELECT f, {_crc_sql("f")} % {im.BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM f), crc_table),
h AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
      FROM f JOIN k USING (f) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + {im.BUCKETS})::DOUBLE)
                                     / ((s + 1)::DOUBLE * (sum(t) OVER () + {im.BUCKETS})::DOUBLE)))::BIGINT AS gain
      FROM h),
m AS (SELECT rid, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
      FROM f JOIN k USING (f) JOIN g USING (bucket) WHERE side = 0 GROUP BY rid),
n AS (SELECT rid, count(*) AS n_words FROM w WHERE side = 0 GROUP BY rid),
x AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features,
             coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{im.SEED}:' || doc_id), 1, 8))::BIGINT
               + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid) WHERE side = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {im.LEAST} ORDER BY score DESC, doc_id) AS r,
             count(*) FILTER (n_words >= {im.LEAST}) OVER () AS drawable FROM x)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {im.LEAST} AND r <= {im.PERCENT} * drawable // 100 THEN r END AS rank FROM o"""


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_cotraining": op5_quality_cotraining,
    "op6_mix_sources": op6_mix_sources,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE = {
    "op4_exact_dedup": _DEDUP,
    "op7_quality_rules": _rules_sql(),
    "op12_merkle_manifest": _manifest_sql(),
    "op13_importance_resampling": _resampling_sql(),
}
