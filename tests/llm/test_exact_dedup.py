"""Exact duplicates by chunk recipes."""
import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regiolake.llm import exact_dedup as X
from regiolake.llm import queries as Q

from .conftest import LONG, PROSE, SF


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        stays = max((i for i in ids if i is not None), default=None)
        sha, left = hashlib.sha256(t.encode()).hexdigest(), True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, stays, len(ids), left and i == stays, sha))
            left = left and i != stays
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_chunks_make_up_the_text_and_survive_edits():
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh ij\n") for _ in range(200_000))
    column = pa.array(["x", text, "", text[:50_000] + "EDIT" + text[50_000:]])
    parts = [[] for _ in range(4)]
    for row, body in X.chunks_of(column):
        parts[row].append(body)
    assert [b"".join(p).decode() for p in parts] == column.to_pylist()
    assert 100 < len(parts[1]) < 400 and all(len(c) <= X.LARGEST for c in parts[1])
    assert len(set(parts[3]) - set(parts[1])) <= 3                    # an edit changes the chunks around it only
    sliced = [b for _, b in X.chunks_of(column.slice(1, 1))]
    assert sliced == parts[1]


def test_places_do_not_depend_on_pieces(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 300_000).astype(np.uint8)
    whole = X.places(data)
    monkeypatch.setattr(X, "PIECE", 10_000)
    assert whole.tolist() == X.places(data).tolist() and len(whole) > 100


def test_edge_cases_against_brute_force(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    out = X.exact_duplicates(edge)
    assert found(out) == brute(rows)
    assert set(out.columns) >= {"Shard", "a.b", "kept", "doc_id"} and "text" not in out.columns
    assert [c.lower() for c in out.columns].count("kept") == 1
    assert X.exact_duplicates(empty).count() == 0


def test_a_group_of_a_third_of_all_rows_and_string_ids(spark):
    rows = [(f"d{i}", PROSE if i % 3 == 0 else LONG[: 5000 + i % 40]) for i in range(300)] + [("é", PROSE), (None, PROSE)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    assert found(X.exact_duplicates(df)) == brute(rows)


def test_identifiers_are_verified(spark):
    """Under seed 0 all chunks of a length share an identifier: the texts must still be told apart."""
    def weak(chunk, seed):
        return bytes([len(chunk) % 256] * 16) if seed == 0 else X.digest(chunk, seed)
    rows = [(i, chr(97 + i % 5) * 40) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert X.verified_seed(df, weak) == 1
    assert found(X.exact_duplicates(df, name=weak)) == brute(rows)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    out = Q.op13_exact_dedup(spark, SF)
    assert found(out) == brute(rows)
    assert out.where(F.col("kept")).count() == len({t for _, t in rows})
