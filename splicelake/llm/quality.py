"""Quality: positive-unlabelled learning with the non-negative risk (Kiryo et al. 2017).

A linear classifier over binned text statistics is fitted on trusted positives
and on unlabelled documents only. Its risk is
``p R+(P) + max(0, R-(U) - p R-(P))``; the share p of good documents among the
unlabelled is estimated from how the scores of both are distributed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled
from .scratch import Scratch, fresh
from .textarray import ALNUM, LETTER, U, slices, tidy, words

BINS = 13


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[np.frombuffer(chars, np.uint8)] = 1
    return out


_CLASSES = np.stack([
    _table(bytes(range(65, 91))),  # capitals
    _table(b"0123456789"),
    _table(b".,;:?'-\"()"),
    _table(b"!"),
    _table(b"|/\\_<>[]{}="),
    _table(b"#$%&*+~^@"),
    _table(b"\n"),
    (~ALNUM & ~_table(bytes(range(128))).astype(bool)).astype(np.int8),
])
NAMES = "capitals digits points calls rules symbols breaks odd letters length words distinct common twice mean_word long_word odd_word line repeated_line".split()


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers (rows, len(NAMES)) of each whole text of a slice."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    per = np.maximum(size, 1)

    def count(flags):
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    out = [count(c[data]) / per for c in _CLASSES]
    out.append(count(LETTER[data]) / per)
    out.append(np.log1p(size))
    w = words(data, offsets)
    many = np.bincount(w.row, minlength=n)
    some = np.maximum(many, 1)
    out.append(np.log1p(many))
    order = np.lexsort((w.hash, w.row))
    row, h = w.row[order], w.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.concatenate((first, [len(row)])))
    out.append(np.bincount(row[first], minlength=n) / some)
    most = np.zeros(n)
    np.maximum.at(most, row[first], times)
    out.append(most / some)
    follow = np.zeros(n)
    if len(w.row) > 1:
        same = (w.row[1:] == w.row[:-1]) & (w.hash[1:] == w.hash[:-1])
        follow = np.bincount(w.row[1:][same], minlength=n)
    out.append(follow / some)
    length = w.end - w.start
    out.append(np.bincount(w.row, length, minlength=n) / some)
    out.append(np.bincount(w.row, length > 20, minlength=n) / some)
    ends_odd = ~(LETTER[data] | np.isin(data, np.frombuffer(b".,;:?'\"", np.uint8)))[w.end - 1] if len(w.row) else np.zeros(0, bool)
    out.append(np.bincount(w.row, ends_odd, minlength=n) / some)
    breaks = data == 10
    lines = count(breaks) + 1
    out.append(np.log1p(size / lines))
    # lines that repeat within a text, by length and first word
    start = np.concatenate((offsets[:-1], np.flatnonzero(breaks) + 1)) if len(data) else offsets[:-1]
    start = np.unique(start[start < len(data)])
    own = np.searchsorted(offsets, start, side="right") - 1
    stop = np.minimum(np.concatenate((start[1:], [len(data)])), offsets[own + 1])
    word = np.searchsorted(w.start, start)
    with np.errstate(over="ignore"):
        mark = np.where(word < len(w.hash), w.hash[np.minimum(word, max(0, len(w.hash) - 1))] if len(w.hash) else U(0), U(0)) + (stop - start).astype(U) * U(0x9E3779B97F4A7C15)
    order = np.lexsort((mark, own))
    again = np.zeros(len(own), bool)
    again[1:] = (own[order][1:] == own[order][:-1]) & (mark[order][1:] == mark[order][:-1])
    out.append(np.bincount(own[order], again, minlength=n) / lines)
    return np.stack(out, axis=1)


class Model(NamedTuple):
    edges: np.ndarray  # (statistics, BINS - 1)
    weights: np.ndarray  # (statistics, BINS)
    bias: float
    prior: float
    threshold: float = 0.3

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, edge in enumerate(self.edges):
            z += self.weights[j][np.searchsorted(edge, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([j * BINS + np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(p: np.ndarray, u: np.ndarray, k: int, gradient, steps: int = 300) -> tuple[np.ndarray, float]:
    w, moment, speed = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        dp, du = gradient(w[p].sum(axis=1) + w[k], w[u].sum(axis=1) + w[k])
        g = np.bincount(p.ravel(), np.repeat(dp, p.shape[1]), minlength=k) + np.bincount(u.ravel(), np.repeat(du, u.shape[1]), minlength=k)
        g = np.append(g + 1e-4 * w[:k], dp.sum() + du.sum())
        moment, speed = 0.9 * moment + 0.1 * g, 0.99 * speed + 0.01 * g * g
        w -= 0.05 * (moment / (1 - 0.9**t)) / (np.sqrt(speed / (1 - 0.99**t)) + 1e-8)
    return w[:k], w[k]


def class_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of both tails at the top (Blanchard et al. 2010), with slack for few rows."""
    best = 1.0
    for q in np.linspace(0.05, 0.95, 46):
        t = np.quantile(sp, q)
        a, b = (sp >= t).mean(), (su >= t).mean()
        best = min(best, b / a + 1 / np.sqrt(len(sp) * a) * 0.5)
    return float(np.clip(best, 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    both = np.concatenate((positive, unlabelled))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros((0, BINS - 1)), np.zeros((0, BINS)), 1.0 if len(positive) else -1.0, 0.5)
    # cuts by rank, closer at the ends, where rare kinds of junk stand; and one between nothing and anything
    q = np.concatenate((np.linspace(0.002, 0.05, 3), np.linspace(0.2, 0.8, BINS - 8), np.linspace(0.95, 0.998, 3)))
    edges = np.sort(np.concatenate((np.quantile(both, q, axis=0).T, np.full((both.shape[1], 1), 1e-9)), axis=1), axis=1)
    p, u = _binned(positive, edges), _binned(unlabelled, edges)
    k = len(edges) * BINS
    # which are labelled, for the prior
    wp, bp = _train(p, u, k, lambda zp, zu: ((_sigmoid(zp) - 1) / len(p), _sigmoid(zu) / len(u)), 150)
    prior = class_prior(wp[p].sum(axis=1) + bp, wp[u].sum(axis=1) + bp)

    def gradient(zp, zu):  # of the bounded sigmoid loss: an estimate of the prior that is a little high then matters little
        sp, su = _sigmoid(zp), _sigmoid(zu)
        dp, du = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        if su.mean() - prior * sp.mean() >= 0:
            return -2 * prior * dp, du
        # the part below zero is overfitting: step back from it
        return prior * dp, -du

    w, b = _train(p, u, k, gradient)
    return Model(edges, w.reshape(len(edges), BINS), float(b), prior)


def measured(docs: DataFrame, keep: tuple[str, ...], score=None) -> DataFrame:
    """``keep`` columns and the statistics (array) or, given a model, the score of each document."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(score)) if score is not None else None

    def scan(batches):
        own = Model(*held.value) if held is not None else None
        for batch in batches:
            for part in slices(batch.column(batch.num_columns - 1)):
                n = len(part.offsets) - 1
                x = statistics(part.data, part.offsets)
                last = pa.array(own.score(x)) if own is not None else pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([c.slice(part.first, n) for c in batch.columns[:-1]] + [last], names=[*keep, "x"])

    (text,) = fresh(docs, "_text")
    source = docs.select(*keep, F.col("text").alias(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(tidy(scan), ", ".join([*fields, f"x {'double' if score is not None else 'array<double>'}"]))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learned from at most about ``labelled.FIT_ROWS`` documents labelled 1 and as many
    documents of any kind, both outside the held-out fold; rows of equal id and text are one document of these. Null and empty texts are
    scored by their statistics, zeros; texts of any length by statistics of the whole.
    Without positives every score is below, without other documents above one half.
    Of a document labelled twice one label counts. Repeated rows give equal rows; a null
    doc_id stays, with a null ``held_out``, and is never learned from. An empty table gives
    no rows; other columns don't matter, whatever their names.
    """
    learn, s = ~held_out(F.col("doc_id")), Scratch(docs.sparkSession, "quality")
    good = labelled.sample(docs, labels.where("quality = 1"), "quality", learn, s)
    h = F.xxhash64("doc_id", "text")
    n = docs.where(learn).agg(F.approx_count_distinct(h, 0.02)).first()[0]  # equal rows count once: none of them alone may fill the sample
    thin = docs.where(learn & (labelled.share(h, salt=29) < labelled.FIT_ROWS / max(n, 1))).select("doc_id", "text").groupBy(h.alias("h")).agg(F.first("text").alias("text"))
    # in one order, so that the fit is the same however the rows are dealt
    p, u = (np.array(sorted(measured(x, ()).toPandas().x.map(tuple)), float).reshape(-1, len(NAMES)) for x in (good, thin))
    model = fit(p, u)
    return measured(docs, ("doc_id",), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("x").alias("score"), (F.col("x") >= model.threshold).cast("int").alias("predicted")
    )
