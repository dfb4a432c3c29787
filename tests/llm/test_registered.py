"""The corpus queries as the driver sees them, and the pipeline against its parts."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.conftest import TINY
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_secrets import everything
from tests.llm.test_texts import linked
from tidemart.llm import pieces
from tidemart.llm.queries import QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def test_all_are_registered():
    named = driver.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in named) == 1
    assert "pipeline" in named


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_sql_gives_the_same_rows(shipped, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TINY}/{table}.parquet'")
    answer = con.execute(QUERIES[name].sql)
    kinds = {c[0]: str(c[1]) for c in answer.description}
    result = driver.queries()[name](shipped, TINY)
    assert {c: KINDS[t] for c, t in result.dtypes} == kinds
    shown = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(shown(r) for r in result.select(*kinds).collect()) == sorted(shown(r) for r in answer.fetchall())


def test_stages(shipped):
    """Each stage, on what the one before kept, does what its operator's brute-force version says."""
    documents = shipped.read.parquet(f"{TINY}/documents.parquet")
    names = [f for _, f in corpus_pipeline.STAGES]
    labels = shipped.read.parquet(f"{TINY}/labels.parquet")

    good = names[0](shipped, documents, TINY).cache()
    assert good.columns == documents.columns
    bad = labels.where("quality = 0 or toxic = 1").select("doc_id")
    fine = labels.where("quality = 1 and toxic = 0").select("doc_id")
    assert good.join(bad, "doc_id").count() <= 0.1 * bad.count()
    assert good.join(fine, "doc_id").count() >= 0.95 * fine.count()

    single = names[1](shipped, good, TINY).cache()
    groups = linked([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in groups})

    clean = names[2](shipped, single, TINY).cache()
    assert clean.columns == documents.columns
    before = {r.doc_id: r.text for r in single.collect()}
    for row in clean.collect():
        if not everything(before[row.doc_id]):
            assert row.text == before[row.doc_id]
        else:
            assert "[SECRET]" in row.text and not [s for s in everything(row.text) if s[0] in ("assign", "access", "hex")]
        assert row.n_chars == len(row.text)

    mix = names[3](shipped, clean, TINY).cache()
    want = {d: t // s for d, s, _, _, t in mixed(clean.collect()) if s}
    assert {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()} == {d: n for d, n in want.items() if n}

    out = names[4](shipped, mix, TINY)
    texts = {r.doc_id: r.text for r in mix.collect()}
    rows = pieces.decode(out).collect()
    assert len(rows) == mix.count()
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_stages_on_odd_and_no_rows(odd_documents, no_documents, shipped):
    documents = odd_documents.select("doc_id", "text", "lang", "source", "n_chars", "size", "copies", "found", "key")
    for rows in (documents, documents.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(shipped, rows, TINY)
            assert out.columns == rows.columns
            assert out.count() <= 3 * rows.count()
        assert corpus_pipeline.STAGES[-1][1](shipped, rows, TINY).count() == rows.count()


def test_no_imports_from_outside():
    """Nothing outside the subpackage names it but the guard in the entry module."""
    from pathlib import Path

    top = Path(driver.__file__).parent
    for path in (top / "tidemart").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
    assert F  # the helpers above need it
