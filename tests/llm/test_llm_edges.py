"""Every operator and stage on nulls, empty and very long texts, repeated rows,
empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
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

LONG = "alpha beta gamma " * 40_000 + "end"
EXTRA = "kept boolean, fp string, size string, n_words string, data string, h int, rep string, src int, block int"
DOC = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
LABELS = "doc_id long, quality int, toxic int, text string"
FILL = (None, "x", "y", "z", "w", 1, "r", 2, 3)


def _docs(spark, rows):
    return spark.createDataFrame([(*r, *FILL) for r in rows], DOC)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 4), (4, LONG, "en", "s", None),
        (5, "same words here and there for all", "en", "s", 5), (5, "same words here and there for all", "en", "s", 5),
        (6, "SAME words here and there for all", "fr", "t", 5), (None, "same words here and there for all", "en", "s", 5),
        (None, None, None, None, None), (None, "another text without an id, long enough to pass the rules of it", "en", "t", 1),
        (7, "<|endoftext|> é́ \U0001f600 \x00 \x1c", "fr", "t", 7), (8, "12345 !!! 678", "de", "t", 8),
        (9, "idiot " * 30, "en", "s", 9), (-3, "negative ids are ids too, and this one is a text of some more words", "de", "", 3),
    ]
    return _docs(spark, rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(9, 0, 1, "t"), (9, 0, 1, "t"), (4, 1, 0, None), (5, 1, 0, None), (6, None, None, None), (None, 1, 1, "q"),
         (3, 1, 0, "")], LABELS)


OPERATORS = {
    "op2": (lambda d, lab: toxicity.op2_toxicity(d, lab), 14),
    "op3": (lambda d, lab: langid.op3_language_id(d), 14),
    "op4": (lambda d, lab: exact_dedup.op4_exact_dedup(d), 14),
    "op5": (lambda d, lab: cotraining.op5_quality_cotraining(d, lab), 14),
    "op6": (lambda d, lab: mixing.op6_mix_sources(d), 14),
    "op7": (lambda d, lab: quality_rules.op7_quality_rules(d), 14),
    "op8": (lambda d, lab: token_counts.op8_token_counts(d), 14),
    "op9": (lambda d, lab: packing.op9_packing(d), None),
    "op10": (lambda d, lab: simhash.op10_simhash_near_dedup(d), 14),
    "op11": (lambda d, lab: sentencepieces.op11_sentencepiece(d), 14),
    "op12": (lambda d, lab: merkle.op12_merkle_manifest(d), 14),
    "op13": (lambda d, lab: importance.op13_importance_resampling(d, d.select(F.col("doc_id").alias("item_id"), "text")), 14),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, odd, labels, name):
    run, n = OPERATORS[name]
    rows = run(odd, labels).collect()
    assert n is None or len(rows) == n
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, 9, -3, None}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, labels, name):
    run, _ = OPERATORS[name]
    empty = spark.createDataFrame([], DOC)
    assert run(empty, spark.createDataFrame([], LABELS)).collect() == []
    assert run(empty, labels).collect() == []


@pytest.mark.parametrize("name", ["op2", "op5"])
def test_no_labels(spark, odd, name):
    rows = OPERATORS[name][0](odd, spark.createDataFrame([], LABELS)).collect()
    assert len({r["score"] for r in rows}) == 1


def test_defined_results(spark, odd):
    dedup = {(r["doc_id"], r["group_size"]): r for r in exact_dedup.op4_exact_dedup(odd).collect()}
    assert dedup[5, 4]["keep_id"] == 6 and not dedup[5, 4]["kept"] and dedup[6, 4]["kept"]
    assert dedup[2, 3]["keep_id"] == 2 and dedup[2, 3]["kept"] and not dedup[1, 3]["kept"]
    prints = {r["doc_id"]: r for r in simhash.op10_simhash_near_dedup(odd.where("doc_id is not null")).collect()}
    assert prints[1]["fingerprint"] == "0" * 16 and prints[3]["component_id"] == 1
    mixed = {r["doc_id"]: r for r in mixing.op6_mix_sources(odd).collect()}
    assert mixed[1]["taken"] == 0 and mixed[1]["size"] == 0 and mixed[4]["size"] == 120_001
    langs = {r["doc_id"]: r for r in langid.op3_language_id(odd).collect()}
    assert langs[1]["lang_pred"] == langs[8]["lang_pred"] == langs[2]["lang_pred"] == "und"
    tokens = {r["doc_id"]: r for r in token_counts.op8_token_counts(odd).collect()}
    assert tokens[1]["n_tokens"] == tokens[2]["n_tokens"] == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, odd, stage):
    assert stage(spark, odd, "").columns == odd.columns
    assert stage(spark, spark.createDataFrame([], DOC), "").collect() == []
    assert all(len(r) == len(odd.columns) for r in stage(spark, odd, "").collect())


def test_one_document_of_each_component_stays(spark, odd):
    same, other = "same words here and there for all", "another text without an id, long enough to pass the rules of it"
    rows = [(r["doc_id"], r["text"]) for r in simhash.stage(spark, odd, "").collect()]
    assert [t for d, t in rows if d is None] == [other]  # its component has no id, others without an id are gone
    assert sorted(d for d, _ in rows if d is not None) == [-3, 1, 4, 5, 7, 8, 9]
    assert rows.count((5, same)) == 1
    two = _docs(spark, [(d, t, "en", "s", 1) for d, t in [
        (1, same), (2, other), (2, same), (None, LONG), (None, LONG.upper()), (3, "a b c d"), (3, "A b c d")]])
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in simhash.stage(spark, two, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, same), (2, other), (3, "a b c d"), (None, LONG.lower())], key=str)


def test_whole_pipeline_on_odd_rows(spark, odd, tmp_path):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.where("offset + length > 4096").isEmpty()


def test_clean_texts_of_other_scripts_stay(spark):
    chinese = " ".join(f"第{i}句话说的是一件很平常的事情，大家都知道它的来龙去脉，" + chr(0x4E00 + i) for i in range(12))
    thai = " ".join("ประโยคนี้เป็นภาษาไทยธรรมดาที่ไม่มีการเว้นวรรคระหว่างคำ" + chr(0xE01 + i) for i in range(12))
    russian = "Сегодня в столице прошла встреча стран NATO и их соседей, о которой писали все газеты мира."
    clean = {1: chinese, 2: thai, 3: russian}
    junk = {4: " ".join("Qx7b" * 8 + str(i) for i in range(12)), 5: "BUY THE NEW CAR NOW OR NEVER, IT IS SO CHEAP ÄÖ",
            6: " ".join("zzz" * 20 + f"话{i}" for i in range(12))}
    docs = _docs(spark, [(i, t, "xx", "s", 1) for i, t in (clean | junk).items()])
    assert {r["doc_id"] for r in quality_rules.stage(spark, docs, "").collect()} == set(clean)


def test_pages(spark):
    rows = [(1, None, None, 1, "a"), (2, "http://h/x", "", 2, "b"), (3, "http://h/x", "<p>a<p>b", 3, "c"),
            (3, "http://h/x", "<p>a<p>b", 3, "c"), (4, "nonsense", "<script>x", 4, "d"),
            (None, "//h", "<article>" + "word " * 100_000, None, None), (5, "http://h/y", "plain &amp; <b>b", 5, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, host string")
    got = sorted(((r["page_id"] or 0, r["text"][:20], r["n_chars"]) for r in html_tree.op1_html_extraction(pages).collect()))
    assert got == [(0, "word word word word ", 499_999), (1, "", 0), (2, "", 0), (3, "a b", 3), (3, "a b", 3), (4, "", 0),
                   (5, "plain & b", 9)]
    assert html_tree.op1_html_extraction(pages.limit(0)).collect() == []
