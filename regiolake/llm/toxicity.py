"""Toxicity: a counterfactually regularised classifier.

A logistic model over hashed words and word beginnings is fitted on labelled rows.  In each labelled
sentence that names a group (an identity term), the term is swapped for the other terms of its kind;
the fit adds ``lam * (z(sentence) - z(swapped))**2`` to the loss, so the score may not rest on which group
is named, and a neutral mention isn't scored as toxic only because the group is often attacked.

Scale: the model is fitted on at most ``max_train`` labelled rows, taken in hash order (a documented
bound; the ids of the sample are broadcast, 16 bytes each).  Their features meet in one task, which fits the model; the
driver gets the model only.  The model (at most 2048 weights) is broadcast, and all documents are scored whole, one row at a time, without
a shuffle.

Defined results
* a null text is scored as an empty one; an empty text gets the model's bias (no features);
* labels that are null, or rows without a label, aren't used for training; of a doc_id with several
  different labels the highest is used;
* without labelled rows of both kinds all scores are near 0 (or near 1, if all labels are toxic);
* repeated rows get equal scores; input columns named like an output column are replaced.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, col, fit_in_task, plain_names
from .features import Hasher, Sparse, adam, informative, words_of

# terms that name a group, by kind; a term is swapped within its kind
IDENTITY = {
    "gender": ("women", "men", "girls", "boys", "woman", "man"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    "origin": ("african", "american", "asian", "european", "immigrant", "refugee"),
    "color": ("black", "white", "brown"),
    "ability": ("disabled", "deaf", "blind", "autistic"),
}
HELD_OUT_MOD = 5
_SENTENCE = re.compile(r"[^.!?\n]+")


def _swaps(identity: dict[str, tuple[str, ...]]) -> dict[bytes, list[bytes]]:
    return {t.encode(): [o.encode() for o in terms if o != t] for terms in identity.values() for t in terms}


def training_rows(batches: Iterator[pa.RecordBatch], identity=IDENTITY) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, text) -> features of the text and, for each swap in a sentence, the features
    that the swap removes and adds."""
    hasher, swaps = Hasher(), _swaps(identity)
    for b in batches:
        feats, gone, new = [], [], []
        for t in b.column("text"):
            text = t.as_py() or ""
            words = words_of(text)
            feats.append(hasher.ids(words).tolist())
            less, more = [], []
            if not swaps.keys().isdisjoint(words):
                for s in _SENTENCE.findall(text):
                    ws = words_of(s)
                    for term in sorted(swaps.keys() & set(ws)):
                        own = set(hasher.ids(ws).tolist())
                        for other in swaps[term]:
                            to = set(hasher.ids([other if w == term else w for w in ws]).tolist())
                            if own != to:
                                less.append(sorted(own - to))
                                more.append(sorted(to - own))
            gone.append(less)
            new.append(more)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("toxic"), pa.array(feats, pa.list_(pa.int32())),
             pa.array(gone, pa.list_(pa.list_(pa.int32()))), pa.array(new, pa.list_(pa.list_(pa.int32())))],
            names=["doc_id", "toxic", "feats", "gone", "new"])


Model = tuple[np.ndarray, np.ndarray, float]           # kept feature ids, their weights, bias


def fit_weights(rows: list[np.ndarray], y: np.ndarray, swaps: list[tuple[list[int], list[int]]], lam: float = 1.0,
                l2: float = 1e-4, toxic_weight: float = 4.0, steps: int = 150, rate: float = 0.1) -> Model:
    """Logistic fit on the informative features; toxic rows, the rare kind, count ``toxic_weight`` times."""
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return np.empty(0, np.int64), np.empty(0), 35.0 if share else -35.0
    x = Sparse(rows, informative(rows, y))
    pair, at, sign = [np.empty(0, int)], [np.empty(0, int)], [np.empty(0)]
    for i, (gone, new) in enumerate(swaps):            # z(sentence) - z(swapped) rests on these features only
        for ids, s in ((gone, 1.0), (new, -1.0)):
            k = x.where[np.asarray(ids, np.int64)]
            k = k[k >= 0]
            pair.append(np.full(len(k), i)), at.append(k), sign.append(np.full(len(k), s))
    pair, at, sign = np.concatenate(pair), np.concatenate(at), np.concatenate(sign)
    wt = np.where(y > 0, toxic_weight, 1.0)
    wt /= wt.sum()
    m = max(1, len(swaps))

    def grad(w):
        z = x.dot(w[:-1]) + w[-1]
        r = wt * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        g = x.back(r) + l2 * w[:-1]
        if len(pair):
            gap = np.bincount(pair, weights=sign * w[at], minlength=m)
            g = g + np.bincount(at, weights=2 * lam / m * sign * gap[pair], minlength=x.n_cols)
        return np.append(g, r.sum())

    w0 = np.zeros(x.n_cols + 1)
    base = float((wt * y).sum())
    w0[-1] = np.log(base / (1 - base))
    w = adam(grad, w0, steps, rate)
    return x.kept, w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 0: such labels are never learned."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(HELD_OUT_MOD)) == 0


def train(docs: DataFrame, labels: DataFrame, max_train: int = 12_000, lam: float = 1.0,
          identity=IDENTITY) -> Model:
    """Fit on labelled rows of ``docs`` that aren't held out; at most ``max_train``, in hash order."""
    use = (labels.select(col("doc_id"), col("toxic").cast("int").alias("toxic"))
           .where(col("doc_id").isNotNull() & col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    text = docs.select(col("doc_id"), col("text"))
    # the sample's ids have a fixed bound: max_train rows of two numbers
    sample = (text.join(F.broadcast(use), "doc_id").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # one text of a repeated id
              .select("doc_id", "toxic", "text"))
    feats = arrow_rows(sample).mapInArrow(
        lambda it: training_rows(it, identity),
        "doc_id long, toxic int, feats array<int>, gone array<array<int>>, new array<array<int>>")
    kept, w, bias = fit_in_task(feats, lambda it: fit_batches(it, lam), "kept array<long>, w array<double>, bias array<double>")
    return kept, w, float(bias[0])


def fit_batches(batches: Iterable[pa.RecordBatch], lam: float) -> Iterator[pa.RecordBatch]:
    """All rows of ``training_rows``, in any order -> the model."""
    rows, y, swaps = [], np.empty(0), []
    if batches := list(batches):
        got = pa.Table.from_batches(batches)
        order = np.lexsort((got.column("toxic").to_numpy(), got.column("doc_id").to_numpy()))
        feats, gone, new = (got.column(c).combine_chunks() for c in ("feats", "gone", "new"))
        rows = [np.asarray(feats[int(i)].values, np.int32) for i in order]
        swaps = [(g, a) for i in order for g, a in zip(gone[int(i)].as_py(), new[int(i)].as_py())]
        y = (got.column("toxic").to_numpy()[order] > 0).astype(float)
    kept, w, bias = fit_weights(rows, y, swaps, lam)
    yield pa.RecordBatch.from_arrays([pa.array([kept], pa.list_(pa.int64())), pa.array([w], pa.list_(pa.float64())),
                                      pa.array([[bias]], pa.list_(pa.float64()))], names=["kept", "w", "bias"])


@plain_names
def score(docs: DataFrame, fitted: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns in ``keep``, by default all but ``score``) with a score between 0 and 1."""
    keep = [c for c in (keep or docs.columns) if c.lower() != "score"]
    model = docs.sparkSession.sparkContext.broadcast(fitted)   # at most 2048 weights
    text = next((c for c in keep if c.lower() == "text"), None)
    # a text that is kept anyway isn't sent twice
    df = docs.select(*[col(c) for c in keep], *([] if text else [col("text")]))
    text, n = text or "text", len(keep)
    schema = docs.select(*[col(c) for c in keep]).withColumn("score", F.lit(0.0)).schema

    def run(batches):
        kept, w, bias = model.value
        column, hasher = {int(i): k for k, i in enumerate(kept)}, Hasher()
        for b in batches:
            texts = b.column(text)
            z = np.fromiter((w[hasher.known(words_of(t.as_py() or ""), column)].sum() for t in texts),
                            float, len(texts)) + bias
            s = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(s)], names=[*b.schema.names[:n], "score"])

    return arrow_rows(df).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, max_train: int = 12_000, threshold: float = 0.5,
             keep: list[str] | None = None) -> DataFrame:
    """Fit on the labels, score every document: ``score``, ``predicted`` (1 if score >= threshold) and
    ``held_out``."""
    out = score(docs, train(docs, labels, max_train), keep)
    return (out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .withColumn("held_out", held_out(col("doc_id"))))
