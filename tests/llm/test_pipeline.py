"""The pipeline: every stage on its own input against brute force, and as a whole."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from regiolake.llm import toxicity
from regiolake.llm.common import read

from .conftest import EDGE_COLUMNS, SF, edge_rows
from .test_cross_document import _brute_components
from .test_text_operators import _brute_hits


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage."""
    docs, out = read(spark, SF, "documents"), {}
    top = tmp_path_factory.mktemp("stages")
    for name, stage in C.STAGES:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        out[name] = (before, docs.collect(), docs.columns)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name in list(stages)[:-1]:
        assert tuple(stages[name][2]) == C.DOCUMENT_COLUMNS


def test_toxicity_stage(spark, stages):
    before, after, _ = stages["toxicity"]
    scored = toxicity.classify(read(spark, SF, "documents"), read(spark, SF, "labels"))
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    assert len(after) < len(before)


def test_near_duplicate_stage(stages):
    before, after, _ = stages["near_duplicates"]
    groups = _brute_components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, _, c in groups if d == c)


def test_near_duplicate_stage_tells_texts_of_one_id_apart(spark):
    """Id 5 has a text of its own, a copy of document 3, and near copies; id 8 the same row twice."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    near = b + " end"
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (5, near), (5, c), (8, c + " x"), (9, "own text"), (9, "own text"), (9, "other")],
                                 "doc_id long, text string")
    docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for parts in (1, 5):
        got = sorted((r["doc_id"], r["text"]) for r in C.near_duplicates(spark, docs.repartition(parts), SF).collect())
        kept_b = [t for d, t in got if t in (b, near)]
        assert len(kept_b) == 1 and got == sorted([(3, a), (5, kept_b[0]), (5, c), (9, "own text"), (9, "other")])


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    hits = _brute_hits([(r["doc_id"], r["text"]) for r in before], items)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, (n, h, _) in hits.items() if not (h > 0 and 20 * h >= n))


def test_mixing_stage_keeps_rows_as_they_are(stages):
    before, after, _ = stages["mixing"]
    assert 0 < len(after) <= len(before) and set(after) <= set(before)


@pytest.mark.parametrize("gone", [["es"], ["es", "fr", "de"]])
def test_mixing_stage_on_input_without_a_domain(spark, gone):
    docs = read(spark, SF, "documents").where(~F.col("lang").isin(gone))
    assert C.mixed(spark, docs, SF).count() > 0.5 * docs.count()


def test_sharding_stage(stages):
    before, after, _ = stages["sharding"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
    by = {}
    for r in after:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_run_is_its_stages(spark, stages):
    got = C.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in stages["sharding"][1])


@pytest.mark.parametrize("rows", [edge_rows(), []])
def test_edge_cases_pass_every_stage(spark, rows):
    docs = spark.createDataFrame(rows, EDGE_COLUMNS)
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() <= max(docs.count(), 0)
