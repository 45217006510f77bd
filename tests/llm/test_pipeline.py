"""The pipeline against plain versions of its stages, and the registered queries against DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from siltworks.llm import decontaminate, quality
from siltworks.llm.queries import ORACLES, QUERIES

from . import corpora

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_the_ordered_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "sharding",
    ]
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept.append([tuple(r) for r in docs.collect()])
        docs = spark.createDataFrame(kept[-1], docs.schema)
        assert docs.columns[:5] == COLUMNS
    good, single, clean, mixed, sharded = kept

    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    # Some 80 ratings are too few to learn toxic words from; test_rows.py has the classifier's held-out accuracy.
    fine = {d for d, r in labels.items() if r["quality"] and not r["toxic"]}
    ids = {r[0] for r in good}
    assert len(ids & fine) > 0.9 * len(fine) and len(good) < spark.read.parquet(f"{SF}/documents.parquet").count()

    groups = corpora.near_components(good)
    assert {r[0] for r in single} == {d for d, (_, root) in groups.items() if d == root} and len(single) == len({r[0] for r in single})

    items = [decontaminate.normal(text) for _, text in benchmark]
    leaks = {r[0] for r in single if any(item in decontaminate.normal(r[1]) for item in items)}
    assert {r[0] for r in clean} == {r[0] for r in single} - leaks

    counts = Counter(r[0] for r in mixed)
    assert max(counts.values()) <= 3 and set(counts) <= {r[0] for r in clean}
    assert Counter(r[:5] for r in sharded) == Counter(mixed)
    assert {r[5] for r in sharded} <= set(range(corpus_pipeline.SHARDS))


def test_run_gives_the_same_rows_again(spark):
    first = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert first and first == Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())


def test_without_ratings_everything_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert quality.keep_good(docs, None).count() == docs.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles_agree(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    ours = QUERIES[name](spark, SF)
    assert sorted(ours.columns) == sorted(columns)
    assert Counter(tuple(r) for r in ours.select(*columns).collect()) == Counter(theirs.fetchall())
    con.close()
