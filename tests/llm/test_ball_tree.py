"""Ranked lexical search under a ball tree."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from regiolake.llm import ball_tree as B
from regiolake.llm import queries as Q

from .conftest import SF


def brute_terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    docs = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := brute_terms(t))]
    n_docs, n_terms = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        times, rows = Counter(brute_terms(text)), []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(v * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, v in times.items() if t in c)
            if s > 0:
                rows.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, r, row[3], -row[0]) for r, row in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_texts(n, seed, most=40):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "Größe", "A1b2"]
    return [" ".join(rnd.choices(words, [1 / (j + 1) for j in range(len(words))], k=rnd.randrange(most))) for _ in range(n)]


def test_terms_of_a_text_do_not_depend_on_pieces(monkeypatch):
    text = "Ab-é9 x" * 500 + "y" * 300 + "--Z"
    whole = [t.decode() for p in B.terms(text) for t in p]
    assert whole == brute_terms(text)
    monkeypatch.setattr(B, "PIECE", 64)
    assert [t.decode() for p in B.terms(text) for t in p] == whole and len(list(B.terms(text))) > 5


@pytest.mark.parametrize("leaf", [1, 4, 16])
def test_bounds_hold_for_every_document_of_every_ball(leaf):
    texts = random_texts(200, 1) + ["same text"] * 40
    items = B.Items.of(list(enumerate([*random_texts(12, 2), "", "unknown"])))
    ptr, idx, tf, n = [0], [], [], []
    for t in texts:
        c = Counter(x for p in B.terms(t) for x in p)
        pairs = sorted((items.vocabulary[x], v) for x, v in c.items() if x in items.vocabulary)
        idx += [p[0] for p in pairs]
        tf += [p[1] for p in pairs]
        ptr.append(len(idx))
        n.append(max(1, sum(c.values())))
    ptr, idx, tf, n = (np.array(x, np.int64) for x in (ptr, idx, tf, n))
    w = np.array([B.weight(len(texts), int(d)) for d in np.bincount(idx, minlength=len(items.vocabulary))], np.int64)
    tree = B.Tree(ptr, idx, B.term_values(tf, np.repeat(n, np.diff(ptr)), len(texts), int(n.sum())), w, items, leaf)
    dense = np.zeros((len(texts), len(w)), np.int64)
    dense[np.repeat(np.arange(len(texts)), np.diff(ptr)), idx] = tree.val * w[idx]
    for item in range(len(items.rows)):
        q = np.zeros(len(w), np.int64)
        cells = slice(items.ptr[item], items.ptr[item + 1])
        q[items.idx[cells]] = items.times[cells]
        for node, docs in enumerate(tree.docs):
            assert tree.bounds[node][item] >= (dense[docs] @ q).max()
    best = B.Best(5)
    best.ids = list(range(len(texts)))
    assert tree.search(0, best) < len(texts) or leaf > 4          # something is left out


def test_against_brute_force_in_blocks(spark):
    docs = [(i, t) for i, t in enumerate(random_texts(300, 3))] + [(7, "w1 w2 é"), (None, "w1 w2 é"), (400, "w1 w2 é"), (401, None), (402, "- -")]
    items = [(f"i{i}", t) for i, t in enumerate(random_texts(9, 4, 12))] + [("i0", "w1 é é"), (None, "GRÖßE größe"), ("e", ""), ("n", None), ("u", "nowhere")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, score int").repartition(5)
    i = spark.createDataFrame([(*x, 2) for x in items], "item_id string, text string, `row` int")
    for block_bytes, tree_rows in ((1 << 20, 4096), (40, 50)):
        assert found(B.search(d, i, k=6, block_bytes=block_bytes, tree_rows=tree_rows)) == brute(docs, items, 6)


def test_blocks_are_bounded(spark):
    rows = [(i, "x" * (i % 50)) for i in range(200)] + [(200, "y" * 500)]
    df = spark.createDataFrame(rows, "row long, text string")
    dealt, n = B.blocks(df, 300)
    by = {}
    for r in dealt.collect():
        by.setdefault(r["block"], []).append(len(r["text"]))
    assert all(len(v) == 1 or sum(v) <= 500 for v in by.values()) and max(by) < n


def test_edge_cases(spark, edge, empty):
    items = spark.createDataFrame([("a", "quick fox"), ("b", "WORT7 und é")], "item_id string, text string")
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert found(B.search(edge, items, k=3)) == brute(rows, [tuple(r) for r in items.collect()], 3)
    assert B.search(empty, items).count() == 0
    assert B.search(edge, items.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(Q.op11_ball_tree_search(spark, SF).select("item_id", "rank", "doc_id", "score")) == brute(docs, items, 20)
