"""Operators over pairs and groups of documents against brute force."""
import random
import struct

import numpy as np
import pytest
import xxhash

from regiolake.llm import jaccard_join as J
from regiolake.llm import line_runs as R
from regiolake.llm import mixing as M
from regiolake.llm import queries as Q
from regiolake.llm import sentence_spans as P
from regiolake.llm.components import connected_components

from .conftest import SF


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


# connected components ------------------------------------------------------------------------------
def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(200, 300)] + [(1000, i) for i in range(1001, 1400)] + \
        [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)]
    links = [(a, b) for a, b in links if a != b]
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {n for x in links for n in x}
    assert {r["node"]: r["root"] for r in connected_components(df).collect()} == _roots(nodes, links)
    assert connected_components(df.limit(0)).count() == 0


# n-gram Jaccard join -------------------------------------------------------------------------------
def _shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def _brute_components(rows):
    sets = [(_shingles(t)) for _, t in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = _roots(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return sorted(((d, len(sets[i]), low.get(root[i])) for i, (d, _) in enumerate(rows)), key=str)


def _near_copies(seed):
    """Groups of near copies at all distances, chains, a passage in many documents, short texts."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randrange(5000)}"
    passage, rows = [word() for _ in range(60)], []
    for g in range(8):
        base = [word() for _ in range(rnd.choice([30, 80, 150]))]
        for _ in range(rnd.choice([2, 5, 40])):
            t = list(base)
            for _ in range(rnd.randrange(0, 5)):
                t[rnd.randrange(len(t))] = word()
            rows.append(" ".join(t))
            if g % 3 == 0:
                base = t                                # a chain
    for _ in range(60):
        own = [word() for _ in range(rnd.choice([5, 20, 60, 300]))]
        at = rnd.randrange(len(own))
        rows.append(" ".join(own[:at] + passage + own[at:]))
    rows += [None, "", " \t", "a b", "A  b", "a b c", "a b c d e", "a b c d e f", rows[0], rows[0].upper(), "É b", "é b"]
    rnd.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(3, rows[3]), (5, "other text"), (None, rows[7]), (None, "alone and without id here")]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_against_brute_force(spark, seed):
    rows = _near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=str)
    assert got == _brute_components(rows)


def test_jaccard_small_filters_lose_nothing(spark):
    """With saturated Bloom filters and little of the hash space known, the order is worse, the result the same."""
    rows = _near_copies(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in J.jaccard_components(df, known=0.05, max_bloom_bits=4096).collect()), key=str)
    assert got == _brute_components(rows)


def test_jaccard_edge_cases(edge, empty):
    got = sorted((tuple(r) for r in J.jaccard_components(edge).collect()), key=str)
    by = {(d, n): c for d, n, c in got}
    assert len(got) == edge.count()
    assert [by[d, 0] for d in (1, 2, 3)] == [1, 2, 3]
    assert {c for d, n, c in got if d in (4, 5)} == {4} and {c for d, n, c in got if d in (6, 7)} == {6}
    assert {c for d, n, c in got if d in (8, 9)} == {8}
    assert J.jaccard_components(empty).count() == 0


# sentence spans ------------------------------------------------------------------------------------
def _split_after(text):
    parts, cur = [], ""
    for i, ch in enumerate(text):
        cur += ch
        if ch == "\n" or ch in ".!?" and i + 1 < len(text) and text[i + 1] in " \t\n\x0b\x0c\r":
            parts.append(cur)
            cur = ""
    return [*parts, cur]


def _brute_spans(rows, span=2, min_chars=40):
    docs = []
    for d, t in rows:
        parts = _split_after(t or "")
        s = [(i, p.strip(" \t\n\x0b\x0c\r").lower()) for i, p in enumerate(parts)]
        docs.append((d, parts, [(i, p) for i, p in s if p]))
    first, out = {}, []
    places = sorted(((d is not None, d or 0), k) for k, (d, _, _) in enumerate(docs))
    for _, k in places:
        d, _, s = docs[k]
        for p in range(len(s) - span + 1):
            run = tuple(x for _, x in s[p:p + span])
            if sum(map(len, run)) >= min_chars:
                first.setdefault(run, (d, p))
    for d, parts, s in docs:
        gone = set()
        for p in range(len(s) - span + 1):
            run = tuple(x for _, x in s[p:p + span])
            if sum(map(len, run)) >= min_chars and first[run] != (d, p):
                gone.update(range(p, p + span))
        drop = {s[k][0] for k in gone}
        out.append((d, len(s), len(gone), "".join(x for i, x in enumerate(parts) if i not in drop)))
    return sorted(out, key=str)


def _passages(seed):
    rnd = random.Random(seed)
    sentence = lambda: " ".join(f"v{rnd.randrange(400)}" for _ in range(rnd.randrange(1, 12))).capitalize() + rnd.choice(".!?")
    shared = [[sentence() for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(60):
        s = [sentence() for _ in range(rnd.randrange(0, 12))]
        for _ in range(rnd.randrange(0, 3)):
            at, p = rnd.randrange(len(s) + 1), rnd.choice(shared)
            a = rnd.randrange(0, 3)
            s[at:at] = p[a:a + rnd.randrange(1, 6)]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(s)))
    return rows + [(100, None), (101, ""), (102, "."), (103, rows[5][1].upper()), (7, rows[7][1]), (None, rows[9][1]), (104, "A. " * 50)]


@pytest.mark.parametrize("seed", [1, 2])
def test_sentence_spans_against_brute_force(spark, seed):
    rows = _passages(seed)
    out = P.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted((tuple(r) for r in out.select("doc_id", "n_sentences", "n_removed", "text").collect()), key=str) == _brute_spans(rows)


def test_op8_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = Q.QUERIES["op8_sentence_spans"](spark, SF)
    assert sorted((tuple(r) for r in out.select("doc_id", "n_sentences", "n_removed", "text").collect()), key=str) == _brute_spans(rows)


def test_sentence_spans_edge_cases(edge, empty):
    out = {(r["doc_id"], r["text"]) for r in P.dedup_spans(edge).collect()}
    assert {(1, ""), (2, ""), (3, " \n\t ")} <= out and P.dedup_spans(edge).count() == edge.count()
    assert P.dedup_spans(empty).count() == 0


# winnowed line runs --------------------------------------------------------------------------------
def _h(data, seed=42):
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(data, seed)))[0]


def _brute_lines(rows, gram=3, window=3):
    docs, occ = [], {}
    for d, t in rows:
        parts = (t or "").split("\n")
        s = [(i, p.strip(" \t\x0b\x0c\r")) for i, p in enumerate(parts)]
        s = [(i, p) for i, p in s if p]
        hs = [_h(p.encode()) for _, p in s]
        g = []
        for k in range(len(hs) - gram + 1):
            x = 42
            for v in hs[k:k + gram]:
                x = _h(struct.pack("<q", v), x & (2 ** 64 - 1))
            g.append(x)
        sel, w = set(), min(window, len(g))
        for a in range(len(g) - w + 1 if g else 0):
            low = min(g[a:a + w])
            sel.add(max(k for k in range(a, a + w) if g[k] == low))
        docs.append((d, parts, s, hs))
        for p in sel:
            occ.setdefault(g[p], []).append(((d is not None, d or 0), _h((t or "").encode()), p, len(docs) - 1))
    gone = [set() for _ in docs]
    for places in occ.values():
        f = min(places)
        for o in places:
            if o[:3] == f[:3]:
                continue
            a, b, shift = docs[o[3]][3], docs[f[3]][3], o[2] - f[2]
            same = lambda k: 0 <= k < len(a) and 0 <= k - shift < len(b) and a[k] == b[k - shift]  # noqa: B023, E731
            lo = hi = o[2]
            while same(lo - 1):
                lo -= 1
            while same(hi + 1):
                hi += 1
            gone[o[3]].update(range(lo, hi + 1))
    out = []
    for (d, parts, s, _), x in zip(docs, gone):
        drop = {s[k][0] for k in x}
        out.append((d, len(s), len(x), "\n".join(p for i, p in enumerate(parts) if i not in drop)))
    return sorted(out, key=str)


def _line_texts(seed):
    rnd = random.Random(seed)
    line = lambda: f"line {rnd.randrange(10_000)}"
    common, blocks = "the common line", [[line() for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(60):
        s = [line() for _ in range(rnd.randrange(0, 10))]
        for _ in range(rnd.randrange(0, 3)):
            at, b, a = rnd.randrange(len(s) + 1), rnd.choice(blocks), rnd.randrange(0, 4)
            s[at:at] = b[a:a + rnd.randrange(2, 9)]
        s.insert(rnd.randrange(len(s) + 1), common)
        if i % 5 == 0:
            s.insert(0, " ")
        rows.append((i, "\n".join(s)))
    return rows + [(100, None), (101, ""), (102, "x\n" * 20), (103, "\n\n"), (104, "a\nb"), (7, rows[7][1]), (None, rows[8][1]),
                   (105, "\n".join(blocks[0] * 3)), (106, "\n".join(f" {x} " for x in blocks[1]))]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_runs_against_brute_force(spark, seed):
    rows = _line_texts(seed)
    out = R.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_removed", "text").collect()), key=str) == _brute_lines(rows)


def test_op9_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = Q.QUERIES["op9_line_runs"](spark, SF)
    assert sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_removed", "text").collect()), key=str) == _brute_lines(rows)


def test_shared_runs_of_gram_and_window_are_found(spark):
    """The guarantee: gram + window - 1 equal lines share a fingerprint."""
    block = [f"shared {i}" for i in range(5)]
    rows = [(i, "\n".join([f"own {i}", *block, f"end {i}"])) for i in range(40)]
    out = R.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["n_removed"] for r in out.orderBy("doc_id").collect()] == [0] + [5] * 39


def test_line_runs_edge_cases(edge, empty):
    assert R.dedup_lines(edge).count() == edge.count() and R.dedup_lines(empty).count() == 0


# mixing --------------------------------------------------------------------------------------------
def _objective(p, t, r, want):
    m = (p * t[:, None]).T @ p
    gap = (r * t) @ p - want
    return gap @ np.linalg.pinv(m) @ gap


def test_rates_match_reachable_targets(spark):
    rnd = np.random.default_rng(0)
    p = rnd.dirichlet([0.3, 0.3, 0.3], 400)
    t = rnd.integers(0, 200, 400)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>")
    steps, want, got = M.fit_rates(df, [0.6, 0.3, 0.1])
    r = M.rates(p, steps, np.inf)
    assert (r >= 0).all() and np.allclose((r * t) @ p, got) and np.abs(got - want).sum() <= 1e-3 * want.sum()


def test_rates_are_the_least_squares_optimum_under_a_ceiling(spark):
    """Targets out of reach: projected gradient on the whole problem, run to the end, does no better."""
    rnd = np.random.default_rng(1)
    p, t = rnd.dirichlet([0.5, 0.5], 200), rnd.integers(1, 100, 200)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>")
    steps, want, _ = M.fit_rates(df, [0.95, 0.05], budget=float(t.sum()), most=1.0, max_steps=60)
    r, best = M.rates(p, steps, 1.0), np.ones(200)
    inv = np.linalg.pinv((p * t[:, None]).T @ p)
    for _ in range(5000):
        best = np.clip(best - p @ (inv @ ((best * t) @ p - want)), 0, 1)
    assert _objective(p, t, r, want) <= 1.02 * _objective(p, t, best, want) + 1e-9


@pytest.mark.parametrize("es", [0.0, 0.001, 0.02])
def test_a_missing_or_scarce_domain_costs_no_other_tokens(spark, es):
    """Shares as the targets, but for one domain without (or with next to no) tokens: its documents and the others stay."""
    p = np.repeat([[0.95 - es, 0.05, es], [0.05, 0.95 - es, es]], [124, 76], axis=0)
    df = spark.createDataFrame([(50, [float(x) for x in b]) for b in p], "n_tokens long, posterior array<double>")
    steps, want, got = M.fit_rates(df, [0.57, 0.35, 0.08], most=1.0)
    r = M.rates(p, steps, 1.0)
    assert r.mean() > 0.9 and np.abs(got - want)[:2].sum() <= 2e-2 * want.sum()


def test_far_targets_are_fitted_to_the_end_or_reported(spark):
    """Many rates at 0 or the ceiling: the optimum is reached, the remaining gap is told, and too few steps are an error."""
    rnd = np.random.default_rng(4)
    p, t = rnd.dirichlet([0.6, 0.6, 0.6], 300), rnd.integers(1, 100, 300)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>")
    weights, budget = [0.97, 0.02, 0.01], 0.9 * t.sum()
    with pytest.warns(UserWarning, match="out of reach"):
        steps, want, got = M.fit_rates(df, weights, budget=float(budget), most=1.0)
    best, inv = np.ones(300), np.linalg.pinv((p * t[:, None]).T @ p)
    for _ in range(20_000):
        best = np.clip(best - p @ (inv @ ((best * t) @ p - want)), 0, 1)
    assert _objective(p, t, M.rates(p, steps, 1.0), want) <= _objective(p, t, best, want) + 1e-5 * budget
    with pytest.raises(RuntimeError, match="not settled"):
        M.fit_rates(df, weights, budget=float(budget), most=1.0, max_steps=2)


def test_a_missing_domain_is_spread_over_the_others(spark):
    p = np.repeat([[0.9, 0.1, 0.0], [0.2, 0.8, 0.0]], 100, axis=0)
    df = spark.createDataFrame([(50, [float(x) for x in b]) for b in p], "n_tokens long, posterior array<double>")
    _, want, got = M.fit_rates(df, [0.4, 0.4, 0.2])
    assert np.allclose(want, [5000, 5000, 0]) and np.abs(got - want).sum() <= 1e-3 * want.sum()


def test_mixing_query_meets_the_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.QUERIES["op5_mixing"](spark, sf).collect()
    assert len(rows) == 1000 and all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in rows)
    sums = np.sum([np.array(r["posterior"]) * r["rate"] * r["n_tokens"] for r in rows], axis=0)
    want = np.array(list(Q.MIX_TARGETS.values())) * sum(r["n_tokens"] for r in rows)
    assert np.abs(sums - want).sum() <= 2e-3 * want.sum()


def test_posteriors_follow_the_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = Q.labelled_domains(docs, labels)
    got = Q.QUERIES["op5_mixing"](spark, sf).join(known.withColumnRenamed("domain", "is"), "doc_id").toPandas()
    assert (got.domain == got["is"]).mean() > 0.9


def test_mixing_edge_cases(spark, edge, empty):
    lab = spark.createDataFrame([(6, "en"), (8, "de"), (None, "en"), (99, "de"), (4, None), (10, "other")], "doc_id long, domain string")
    out = M.mix(edge, lab, {"en": 0.5, "de": 0.5}, most=1.0)
    assert out.count() == edge.count() and out.where("rate < 0 OR rate > 1").count() == 0
    assert M.thinned(out).count() <= edge.count()
    assert M.mix(edge, lab.limit(0), {"en": 1.0}).count() == edge.count()
    assert M.mix(empty, lab, {"en": 0.5, "de": 0.5}).count() == 0
