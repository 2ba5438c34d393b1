import zlib

import pytest
from pyspark.sql import functions as F

from regiolake.llm import kd_sharding as K
from regiolake.llm import queries as Q

from .conftest import SF

DIMS = {"lang": "category", "source": "category", "n_chars": "magnitude"}


def _check(rows, want_ids, num_shards):
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == want_ids
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= s < num_shards for s in by)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_query_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = Q.QUERIES["op1_kd_sharding"](spark, SF).collect()
    _check(rows, sorted(d["doc_id"] for d in docs), 24)
    text = {d["doc_id"]: d["text"] for d in docs}
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes" and r["grown_shard"] is None


def test_shards_are_near_equal_with_a_hot_source(spark):
    """A third of the rows share source, language and length."""
    df = (spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 50)).alias("source"), F.lit("en").alias("lang"),
        F.repeat(F.lit("x"), F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id").cast("int") % 200)).alias("text"))
        .withColumn("n_chars", F.length("text").cast("long")))
    out = K.shard_documents(df, DIMS, num_shards=7, carry=False)
    by = [r["b"] for r in out.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(by) == 7 and max(by) - min(by) < 0.05 * sum(by) / 7


def test_cut_is_the_weighted_quantile(spark):
    """The tree's first cut against a sort of all points."""
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") * 37 % 91).cast("int")).alias("text"),
                                  (F.col("id") % 977).alias("n_chars"))
    pts = K.points_of(df, {"n_chars": "magnitude"}).select("doc_id", "size", "text_crc32", "_kd_x")
    tree = K.fit(pts, 1, num_shards=2, tolerance=1e-6)
    (_, dim, cut), = tree.levels[0]
    rows = sorted((r["_kd_x"][0], r["size"]) for r in pts.collect())
    left = sum(s for x, s in rows if x < cut)
    assert dim == 1 and abs(left - sum(s for _, s in rows) / 2) <= max(s for _, s in rows)


def test_target_bytes(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("z"), 92).alias("text"), F.lit(1).alias("n_chars"))
    out = K.shard_documents(df, {"n_chars": "magnitude"}, target_bytes=20_000, carry=False)
    assert out.select("shard").distinct().count() == 5


@pytest.mark.parametrize("carry", [True, False])
def test_edge_cases(spark, edge, empty, carry):
    out = K.shard_documents(edge, DIMS, num_shards=3, carry=carry)
    rows = out.collect()
    assert len(rows) == edge.count()
    _check(rows, sorted([1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10]), 3)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {8}
    assert len({r["shard"] for r in rows if r["doc_id"] == 6}) == 1
    assert [c.lower() for c in out.columns].count("shard") == 1
    assert K.shard_documents(empty, DIMS, num_shards=3, carry=carry).count() == 0


def test_the_tree_is_no_join_and_places_rows_as_a_walk_does(spark):
    """Every join of a level was a broadcast that the driver planned and kept, in every round of the search."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") * 37 % 91).cast("int")).alias("text"),
                                  (F.col("id") % 977).alias("n_chars"), (F.col("id") % 3).alias("lang"))
    pts = K.points_of(df, {"n_chars": "magnitude", "lang": "category"}).select("doc_id", "size", "text_crc32", "_kd_x")
    tree = K.fit(pts, 2, num_shards=24)
    out = tree.assign(pts)
    assert len(tree.levels) == 5 and "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    cuts = {n: (d, x) for level in tree.levels for n, d, x in level}

    def walk(x):
        n = 1
        while n in cuts:
            n = 2 * n + (x[cuts[n][0] - 1] >= cuts[n][1])
        return tree.shards[n]
    rows = out.collect()
    assert len(rows) == 4000 and all(r["shard"] == walk(r["_kd_x"]) for r in rows)
    assert tree.assign(pts).where("shard = 5").count() == sum(walk(r["_kd_x"]) == 5 for r in rows)
