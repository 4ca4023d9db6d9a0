"""The operators' queries against DuckDB, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_operators import plain_components, plain_fingerprint
from tillworks.llm.queries import ORACLE_SQL, QUERIES
from tillworks.session import materialise
from tools.compare import compare, duck


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_statement(spark, name):
    difference, _, _ = compare(spark, duck(SMALL), SMALL, name, QUERIES[name], ORACLE_SQL[name])
    assert difference is None


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(materialise(stage(spark, steps[-1], SMALL), "test"))
    for step in steps[1:5]:
        assert step.columns == docs.columns
    cleaned, exact, near, mixed, pieces = [s.collect() for s in steps[1:]]
    last = {}
    for r in cleaned:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert Counter(r["doc_id"] for r in exact) == Counter(last.values())
    groups = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in exact])
    assert sorted(r["doc_id"] for r in near) == sorted(set(groups.values()))
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in near}
    assert Counter((r["doc_id"], r["rank"]) for r in pieces if r["rank"] == 0) == Counter((r["doc_id"], 0) for r in mixed)
    assert all(r["round_trip"] for r in pieces)
