import pytest
from test_lsh_forest import brute as brute_components
from test_prefix_free import brute as brute_repeats

import corpus_pipeline as cp
from siltworks.llm.shared import documents, written

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    docs, out = written(documents(spark, SMALL), "documents"), {}
    for name, stage in cp.STAGES:
        found = written(stage(spark, docs, SMALL), name)
        out[name] = (docs, found)
        docs = found
    return out


def test_stage_names_and_columns(spark, stages):
    assert list(stages) == ["quality_classifier", "quality_rules", "near_duplicates", "repeated_passages", "packing"]
    columns = documents(spark, SMALL).columns
    for name, (_, found) in stages.items():
        assert (found.columns == columns) == (name != "packing")


def test_filters_keep_whole_rows(stages):
    for name in ("quality_classifier", "quality_rules", "near_duplicates"):
        docs, found = stages[name]
        assert found.count() == found.join(docs, docs.columns, "leftsemi").count() > 0


def test_one_document_of_each_group_stays(stages):
    docs, found = stages["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    judged, groups = brute_components(rows, 80, 5)
    assert {r["doc_id"] for r in found.collect()} == {i for i, n, _, kept in judged if kept or not n}
    assert found.count() == groups


def test_passages_are_cut_from_the_survivors(stages):
    docs, found = stages["repeated_passages"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {i: kept.decode("utf-8", "ignore") for (i, _), (*_, kept) in zip(rows, brute_repeats([t for _, t in rows], 200), strict=True)}
    got = {r["doc_id"]: r for r in found.collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_run_packs_every_survivor(spark, stages):
    docs, pieces = stages["packing"]
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}
    by_doc = {}
    for r in pieces.collect():
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for parts in by_doc.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total


def test_stages_take_empty_tables_and_further_columns(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, SMALL).limit(12).withColumns({"n": F.lit(1), "k": F.lit("x"), "_k": F.lit(2), "kept": F.lit(False), "row": F.lit(1), "s": F.lit(1), "_row": F.lit(3), "a.b": F.lit(4)})
    nulls = docs.limit(2).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    for name, stage in cp.STAGES:
        empty = stage(spark, docs.where("false"), SMALL)
        assert empty.count() == 0
        found = stage(spark, docs.unionByName(nulls).unionByName(docs.limit(3)), SMALL)
        assert found.count() >= 0 and (name == "packing" or found.columns == docs.columns)
