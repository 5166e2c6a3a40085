"""The stages against brute force, each on its own input; edge rows; the registered run."""

from __future__ import annotations

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sharelens.llm import bpe, queries

from .conftest import MESSY, SF_SMALL
from .test_row_operators import _digests
from .test_set_operators import _classes, _contamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def reference():
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    tok.no_truncation()
    tok.no_padding()
    return tok


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage got and gave on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF_SMALL)
        rows = done.collect()
        out[name] = (docs, rows, done.columns)
        docs = spark.createDataFrame(rows, done.schema)
    return out


def test_stages_are_the_dealt_ones():
    assert list(STAGES) == ["quality", "lines", "near", "benchmark", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_stay(steps):
    for name, (_, _, columns) in steps.items():
        assert columns[:5] == COLUMNS and (len(columns) == 5 or name == "tokens")


def test_quality_keeps_what_op7_keeps(spark, steps):
    _, rows, _ = steps["quality"]
    kept = {r["doc_id"] for r in queries.QUERIES["op7_quality_rules"](spark, SF_SMALL).where("kept").collect()}
    assert {r["doc_id"] for r in rows} == kept


def test_lines_keep_every_document(steps):
    docs, rows, _ = steps["lines"]
    before = {r["doc_id"]: r for r in docs.collect()}
    assert len(rows) == len(before)
    changed = [r for r in rows if r["text"] != before[r["doc_id"]]["text"]]
    assert changed and all(len(r["text"]) < len(before[r["doc_id"]]["text"]) for r in changed)
    assert all(r[c] == before[r["doc_id"]][c] for r in rows for c in COLUMNS if c != "text")


def test_near_keeps_the_first_of_each_class(steps):
    docs, rows, _ = steps["near"]
    want = _classes([(r["doc_id"], r["text"]) for r in sorted(docs.collect(), key=lambda r: r["doc_id"])])
    assert sorted(r["doc_id"] for r in rows) == sorted(set(want.values()))


def test_benchmark_drops_the_contaminated(spark, steps):
    docs, rows, _ = steps["benchmark"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = _contamination([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(x[0] for x in want if not x[5])


def test_tokens_equal_the_library(steps, reference):
    docs, rows, _ = steps["tokens"]
    assert len(rows) == docs.count()
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == _digests(reference, r["text"]) for r in rows)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in steps["tokens"][1])


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_on_edge_rows_and_empty_tables(spark, messy, nothing, name):
    got = STAGES[name](spark, messy, SF_SMALL)
    assert got.columns[:len(messy.columns)] == messy.columns
    assert len(got.collect()) <= len(MESSY)
    assert STAGES[name](spark, nothing, SF_SMALL).collect() == []
