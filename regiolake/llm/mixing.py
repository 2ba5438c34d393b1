"""Mixing sources to target weights with soft membership.

A classifier fitted on a labelled table gives every document a posterior over domains (a text may be part
of several).  With tokens t_i, posteriors p_i and a rate r_i for each document, the expected tokens of
domain d are S_d = sum_i r_i t_i p_id.  Nonnegative rates are fitted by projected gradient steps on the
least squares (S - T)' M^-1 (S - T) with M = sum_i t_i p_i p_i'; in this metric the step length is 1.  A rate
depends on its document only through p_i and the gradients so far, which are a few short vectors: so each
(accelerated) step is one pass that rebuilds the rates from them and adds up S, and nothing is shuffled or
kept but the table of posteriors.

Under a ceiling a mixture that meets all targets has at most as many tokens as the scarcest domain allows: with a
domain at a share x of its target, x of all tokens.  So a domain below ``scarce`` (half) of its target share isn't
aimed at: nothing is thinned on its account, its own documents keep their rates, and the other domains are mixed
to their rescaled targets.

Scale: the classifier is fitted on at most ``max_train`` labelled rows in hash order (a documented bound; the
ids are broadcast), in one task.  All documents are counted and fitted.  The driver sees the model and sums by domain only.

Defined results: a null or empty text has 0 tokens, and its posterior is the model's prior; labelled rows
with a null domain or an id that isn't in the documents aren't used; a domain of the targets without
labelled rows has posterior 0 and gets no tokens: it is left out, and the other targets are rescaled; with fewer than two
labelled domains the posterior is 1 for the one there is, or equal shares of the targets' domains without
labels; repeated rows get equal rates; an empty table gives an empty result.  Input columns named
like an output column are replaced.
"""
from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, col, fit_in_task, others, plain_names, stored
from .features import Hasher, Lexicon, Sparse, adam, informative, words_of

OUT = ("n_tokens", "posterior", "domain", "rate")


def fit_posterior(rows: list[np.ndarray], y: np.ndarray, n_domains: int, top: int = 512, l2: float = 1e-4,
                  steps: int = 80, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Softmax regression on the features that tell each domain from the rest: kept ids, weights, biases."""
    share = np.bincount(y, minlength=n_domains) / max(1, len(y))
    prior = np.log(np.maximum(share, 1e-30))
    if len(y) == 0:
        prior = np.zeros(n_domains)
    if (share > 0).sum() < 2:
        return np.empty(0, np.int64), np.empty((0, n_domains)), prior
    kept = np.unique(np.concatenate([informative(rows, (y == d).astype(float), top) for d in range(n_domains) if 0 < share[d] < 1]))
    x, target, n = Sparse(rows, kept), np.eye(n_domains)[y], len(y)

    def grad(w):
        w = w.reshape(-1, n_domains)
        z = np.stack([x.dot(w[:-1, d]) for d in range(n_domains)], 1) + w[-1]
        p = _softmax(z)
        r = (p - target) / n
        g = np.stack([x.back(r[:, d]) for d in range(n_domains)], 1) + l2 * w[:-1]
        return np.vstack([g, r.sum(0)]).ravel()

    w = adam(grad, np.vstack([np.zeros((len(kept), n_domains)), np.maximum(prior, -12)]).ravel(), steps, rate)
    w = w.reshape(-1, n_domains)
    bias = np.where(share > 0, w[-1], -1e30)
    return kept, w[:-1], bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], max_train: int = 4000):
    """``labelled``: (doc_id, domain)."""
    use = (labelled.select(col("doc_id"), col("domain")).where(col("doc_id").isNotNull() & col("domain").isin(domains))
           .groupBy("doc_id").agg(F.min("domain").alias("domain"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    sample = (docs.select(col("doc_id"), col("text")).join(F.broadcast(use), "doc_id")     # a fixed number of ids
              .groupBy("doc_id").agg(F.min("domain").alias("domain"), F.min("text").alias("text")))
    sample = stored(sample, "mixing-sample")

    def run(batches):
        hasher = Hasher()
        for b in batches:
            feats = [hasher.ids(words_of(t.as_py() or "")).tolist() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("domain"), pa.array(feats, pa.list_(pa.int32()))],
                                             names=["doc_id", "domain", "feats"])

    feats = arrow_rows(sample).mapInArrow(run, "doc_id long, domain string, feats array<int>")
    kept, w, bias = fit_in_task(feats, lambda it: fit_batches(it, domains), "kept array<long>, w array<double>, bias array<double>")
    w = w.reshape(-1, len(domains))
    at = {int(i): k for k, i in enumerate(kept)}

    def names(batches):
        hasher = Hasher()
        for b in batches:
            found = {(n, s, at[i]) for t in b.column("text") for x in set(words_of(t.as_py() or ""))
                     for n, s, i in hasher.named(x) if i in at}
            n, s, c = zip(*sorted(found)) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(s, pa.string()), pa.array(c, pa.int32())],
                                             names=["n", "s", "c"])

    # the words behind the kept features, as the sample has them: a few for each feature
    told = arrow_rows(sample.select("text")).mapInArrow(names, "n int, s string, c int").distinct().toArrow()
    return sorted(zip(*(told.column(c).to_pylist() for c in ("n", "s", "c")))), w, bias


def fit_batches(batches: Iterable[pa.RecordBatch], domains: list[str]) -> Iterator[pa.RecordBatch]:
    """All rows (doc_id, domain, feats) of the sample, in any order -> kept ids, weights by row, biases."""
    rows, y = [], np.empty(0, int)
    if batches := list(batches):
        got = pa.Table.from_batches(batches)
        order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
        feats, names = got.column("feats").combine_chunks(), got.column("domain").to_pylist()
        rows = [np.asarray(feats[int(i)].values, np.int32) for i in order]
        y = np.array([domains.index(names[int(i)]) for i in order], int)
    kept, w, bias = fit_posterior(rows, y, len(domains))
    yield pa.RecordBatch.from_arrays([pa.array([kept], pa.list_(pa.int64())), pa.array([w.ravel()], pa.list_(pa.float64())),
                                      pa.array([bias], pa.list_(pa.float64()))], names=["kept", "w", "bias"])


def posteriors(docs: DataFrame, model, n_domains: int, carry: list[str] | None = None,
               fitted: tuple[list[tuple[np.ndarray, float]], float] | None = None) -> DataFrame:
    """``docs`` (the columns in ``carry``, by default all) with ``n_tokens`` and ``posterior``, and with ``fitted`` (steps,
    ceiling) ``rate`` from the same pass."""
    keep = others(docs.select(*[col(c) for c in carry]) if carry is not None else docs, OUT)
    has = any(c.lower() == "text" for c in keep)       # a text that is kept anyway isn't sent twice
    df = docs.select(*[col(c) for c in keep], *([] if has else [col("text")]))
    text_at = next(i for i, c in enumerate(df.columns) if c.lower() == "text")
    schema = docs.select(*[col(c) for c in keep]).schema.add("n_tokens", "long").add("posterior", T.ArrayType(T.DoubleType()))
    if fitted is not None:
        schema = schema.add("rate", "double")
    shared = docs.sparkSession.sparkContext.broadcast((*model, fitted))      # a few thousand words and weights

    def run(batches):
        names, w, bias, fitted = shared.value
        lexicon = Lexicon(names)
        for b in batches:
            tokens, own, at = [], [], []
            for k, t in enumerate(b.column(text_at)):
                text = t.as_py() or ""
                tokens.append(len(text.split()))
                found = lexicon.columns(text)
                own += [k] * len(found)
                at += found
            cells = w[np.array(at, int)] if at else np.empty((0, n_domains))
            p = _softmax(bias + np.stack([np.bincount(np.array(own, int), cells[:, d], b.num_rows) for d in range(n_domains)], 1))
            out = [*(b.column(c) for c in keep), pa.array(tokens, pa.int64()),
                   pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * n_domains, pa.int32()), pa.array(p.ravel()))]
            if fitted is not None:
                out.append(pa.array(rates(p, *fitted) if b.num_rows else np.empty(0)))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema.fields])

    return arrow_rows(df).mapInArrow(run, schema)


def rates(p: np.ndarray, steps: list[tuple[np.ndarray, float]], most: float) -> np.ndarray:
    """Rates of documents with posteriors ``p`` after the steps (gradient, momentum) so far."""
    r = last = np.full(len(p), min(1.0, most))
    for g, momentum in steps:
        r, last = np.clip(r + momentum * (r - last) - p @ g, 0.0, most), r
    return r


def _matrix(b: pa.RecordBatch, n: int) -> np.ndarray:
    return b.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def reachable(have: np.ndarray, w: np.ndarray, scarce: float) -> np.ndarray:
    """Which domains are aimed at: those with a target and tokens, less the scarcest one as long as it has under
    ``scarce`` of its share of the tokens of those that are left."""
    on = (w > 0) & (have > 1e-9 * have.sum())
    while on.sum() > 1:
        share = np.where(on, have / np.where(on, w, 1.0) * (w[on].sum() / have[on].sum()), np.inf)
        if share.min() >= scarce:
            break
        on[share.argmin()] = False
    return on


def fit_rates(table: DataFrame, weights: list[float], budget: float | None = None, most: float = np.inf,
              max_steps: int = 300, tolerance: float = 1e-3, scarce: float = 0.5
              ) -> tuple[list[tuple[np.ndarray, float]], np.ndarray, np.ndarray]:
    """Accelerated gradient steps, targets and reached totals.  ``budget``: tokens of the domains aimed at; None: with a ceiling
    on the rates the most that none of them runs short of, else all their tokens.  The target of a domain that isn't
    aimed at is what it has.  Ends when the totals are within ``tolerance`` of the targets, or (targets out of reach)
    when three steps in a row change the objective by less than a millionth of the budget; a gap that is left is warned
    of, and rates that still change after ``max_steps`` are an error."""
    n, sums = len(weights), "s array<double>"

    def passed(fn) -> np.ndarray:
        def run(batches):
            for b in batches:
                if b.num_rows:
                    p, t = _matrix(b, n), b.column("n_tokens").to_numpy().astype(float)
                    yield pa.RecordBatch.from_arrays([pa.array([fn(p, t).tolist()], pa.list_(pa.float64()))], names=["s"])
        parts = table.select("n_tokens", "posterior").mapInArrow(run, sums)
        size = n + n * n if fn is moments else n
        row = parts.agg(*[F.sum(F.col("s")[k]) for k in range(size)]).first()
        return np.array([x or 0.0 for x in row])

    def moments(p, t):
        return np.concatenate([t @ p, ((p * t[:, None]).T @ p).ravel()])

    first = passed(moments)
    have, m = first[:n], first[n:].reshape(n, n)
    w = np.asarray(weights, float) / sum(weights)
    on = reachable(have, w, scarce if budget is None and np.isfinite(most) else 0.0)
    w = np.where(on, w, 0.0) / (w[on].sum() if on.any() else 1.0)
    if budget is None:
        budget = have[on].sum() if not np.isfinite(most) else most * min(have[on] / w[on], default=0.0)
    want = np.where(on, w * budget, have * min(1.0, most))
    inverse = np.zeros((n, n))                         # no step along the domains that are left out
    inverse[np.ix_(on, on)] = np.linalg.pinv(m[np.ix_(on, on)], rcond=1e-9, hermitian=True)
    steps, s = [], have * min(1.0, most)
    before, t, still, objective = s, 1.0, 0, np.inf
    while (gap := np.abs(s - want)[on].sum()) > tolerance * max(budget, 1.0):
        now = (s - want) @ inverse @ (s - want)
        still = still + 1 if abs(objective - now) <= 1e-6 * max(budget, 1.0) else 0
        if still == 3:
            warnings.warn(f"targets out of reach: {gap:.0f} of {budget:.0f} tokens off, by domain {np.round(s - want).tolist()}")
            break
        if len(steps) == max_steps:
            raise RuntimeError(f"rates not settled after {max_steps} steps: {gap:.0f} of {budget:.0f} tokens off")
        if now > objective:                            # the momentum went too far: start again from here
            t, before = 1.0, s
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        momentum, t, objective = (t - 1) / after, after, now
        steps.append((inverse @ (s + momentum * (s - before) - want), momentum))
        before, s = s, passed(lambda p, k: (rates(p, steps, most) * k) @ p)
    return steps, want, s


@plain_names
def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None,
        most: float = np.inf, max_train: int = 4000, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns in ``carry``, by default all) with ``n_tokens``, ``posterior`` (in the order of
    ``targets``), ``domain`` (the likeliest) and ``rate``, between 0 and ``most``."""
    domains = list(targets)
    n, model = len(domains), train(docs, labelled, domains, max_train)
    columns = others(docs if carry is None else docs.select(*[col(c) for c in carry]), OUT)
    texts = "text" in [c.lower() for c in columns]     # texts aren't written again; their posteriors are made twice
    thin = stored(posteriors(docs, model, n, [] if texts else carry), "mixing-posteriors")
    steps, _, _ = fit_rates(thin, [targets[d] for d in domains], budget, most)
    if texts:
        rated = posteriors(docs, model, n, carry, (steps, most))
    else:
        schema = T.StructType([*thin.schema.fields, T.StructField("rate", T.DoubleType())])

        def run(batches):
            for b in batches:
                r = rates(_matrix(b, n), steps, most) if b.num_rows else np.empty(0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r)], names=[*b.schema.names, "rate"])
        rated = thin.mapInArrow(run, schema)
    names = F.array(*[F.lit(d) for d in domains])
    likeliest: Column = F.get(names, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1)
    return rated.withColumn("domain", likeliest)


def thinned(mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows kept with probability ``rate`` (at most 1), decided by a hash of id and text: the same documents in
    every run and partitioning."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), col(key), F.xxhash64(col(text))), 11) / F.lit(2.0 ** 53)
    return mixed.where(u < F.col("rate"))
