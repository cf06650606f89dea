"""Text queries with a SQL twin equal it; the others run over whole tables."""

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL, SF_SMOKE
from trip_engine.llm.queries import ORACLE, QUERIES


def _plain(v):
    """Whole numbers with nulls among them come as floats or as integers."""
    return "" if pd.isna(v) else str(int(v) if isinstance(v, float) and v.is_integer() else v)


def _rows(frame):
    cols = sorted(frame.columns)
    return cols, sorted(tuple(map(_plain, r)) for r in frame[cols].itertuples(index=False))


@pytest.mark.parametrize("sf_dir", [SF_SMOKE, SF_SMALL])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_twin(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    assert _rows(QUERIES[name](spark, sf_dir).toPandas()) == _rows(con.execute(ORACLE[name]).df())


def test_one_query_per_operator():
    import __spark_entry__ as ent
    names = ent.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names


def test_rules_on_nasty_texts(spark):
    """The measurements equal the SQL twin on white space, marks and repeats."""
    import random

    rnd = random.Random(5)
    parts = ["a", "bb", "é", "ß汉", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\xa0", "\x85", "\x1c", "#", "*|", "A", "Z9", "話す", "ไทย", "Привет", "²½Ⅷ", "٣"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(4, 30))) for _ in range(200)] + [None, ""]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents)
    from trip_engine.llm.quality_rules import op7_quality_rules
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert _rows(op7_quality_rules(docs).toPandas()) == _rows(con.execute(ORACLE["op7_quality_rules"]).df())
