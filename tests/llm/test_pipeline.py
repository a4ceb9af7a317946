"""The registered queries with SQL against DuckDB, and the pipeline."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import corpus_pipeline as P
from tests.compare import connect, differences
from tests.llm import cases
from tidemark.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_its_sql(spark, name):
    with connect(SF_DIR) as con:
        assert differences(queries.QUERIES[name](spark, SF_DIR), con, queries.ORACLES[name]) == []


@needs_tables
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_has_a_row_for_each_of_its_table(spark, name):
    table = "pages" if "html" in name else "documents"
    assert queries.QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def corpus(spark, tmp_path):
    prose = [f"this is text number {i} with its own words w{i} x{i} y{i} z{i} and so on to the end of it {i * i}" for i in range(60)]
    near = prose[3] + " but longer by a few " + " ".join(f"v{i}" for i in range(60))
    rows = [(i, t, "en", "src", len(t)) for i, t in enumerate(prose)]
    item = " ".join(f"item{i}" for i in range(20))
    rows += [
        (100, near, "en", "src", len(near)), (101, near + " tail", "en", "src", len(near) + 5),
        (102, prose[5], "en", "src", len(prose[5])), (103, "12345 !!!", "en", "src", 9), (104, None, None, None, None),
        (105, "before it " + item, "en", "src", 5), (106, prose[6] + "\nan own second line of document 106", "en", "src", 0),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_decisions_of_the_stages(spark, tmp_path):
    sf_dir = corpus(spark, tmp_path)
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in P.STAGES:
        after = stage(spark, docs, sf_dir)
        if name != P.STAGES[-1][0]:
            assert after.schema.names == docs.schema.names
        after.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    language, lines, near, clean, encoded = kept
    assert 103 not in language and 104 not in language and set(range(60)) <= set(language)
    assert 102 not in lines and lines[106].text == "an own second line of document 106" and lines[106].n_chars == 34
    assert 100 in near and 101 not in near and 105 in near
    assert set(clean) == set(near) - {105} and set(range(60)) <= set(clean)
    assert set(encoded) == set(clean) and all(r.n_tokens > 0 for r in encoded.values())
    assert sorted(r.ids_sha256 for r in P.run(spark, sf_dir).collect()) == sorted(r.ids_sha256 for r in encoded.values())


def test_stages_bear_odd_and_no_rows(spark, tmp_path):
    sf_dir = corpus(spark, tmp_path)
    for docs in (cases.documents(spark), cases.empty(spark)):
        docs = docs.selectExpr("*", "length(text) AS n_chars")
        for _, stage in P.STAGES:
            assert stage(spark, docs, sf_dir).count() <= docs.count()


def test_short_lines_go_as_equal_lines(spark, tmp_path):
    rows = [(i, f"Menu\nown line {i} with more words w{i}", "en", "src", 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text.split("\n")[0] for r in P.dedup_lines(spark, docs, str(tmp_path)).collect()}
    assert got == {0: "Menu", 1: "own line 1 with more words w1", 2: "own line 2 with more words w2"}


def test_passages_of_clean_documents_go(spark, tmp_path):
    sf_dir = corpus(spark, tmp_path)
    item, words = " ".join(f"item{i}" for i in range(20)), " ".join(f"own{i}" for i in range(800))
    rows = [(1, f"{words} {item} {words}", "en", "src", 0), (2, words, "en", "src", 7), (3, f"own {item}", "en", "src", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.remove_contaminated(spark, docs, sf_dir).collect()}
    left = f"{words}  {words}"
    assert got == {1: (left, len(left)), 2: (words, 7)}


def test_one_of_repeated_rows_stays(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " tail", " ".join(f"v{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text), (1, near), (1, other), (2, text), (3, near), (4, None), (4, None), (4, ""), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row string")
    got = sorted(((r.doc_id, r.text) for r in P.dedup_documents(spark, docs, str(tmp_path)).collect()), key=str)
    one = [t for i, t in got if i == 1 and t != other]
    assert len(one) == 1 and one[0] in (text, near)
    assert [g for g in got if g not in ((1, text), (1, near))] == sorted([(1, other), (4, None), (4, ""), (None, "alone")], key=str)
