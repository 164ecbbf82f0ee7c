"""Toxicity: a linear classifier whose scores don't move when identity terms are swapped.

Features are the letter runs of a text and their prefixes, each counted once a
document, hashed into a table of fixed size. Those that labelled toxic documents
have far more often than others are kept, and a logistic regression is fitted
on them. For every labelled text that names a group of people, a copy with that
term swapped for another group and one with it swapped for a neutral word are
scored too, and the squared change of the score is part of the loss
(counterfactual logit pairing, Garg et al. 2019).
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled
from .scratch import Scratch, fresh
from .textarray import LETTER, LOWER, U, mix64, running, runs, slices, span_hash, tidy

BITS = 20
PREFIXES = (3, 4, 5, 6, 7, 8)
#: How a feature that is kept must stand out: documents, ratio of rates, log-likelihood ratio.
LEAST_DOCS, LEAST_RATIO, LEAST_G2 = 3, 4.0, 12.0
#: Weight of the squared score change between a text and its counterfactual.
PAIRING = 5.0

# Terms for groups of people, and a neutral word for each language.
IDENTITY = {
    "person": "women men girls boys gay lesbian bisexual transgender queer straight black white asian african european american arab latino jewish muslim christian hindu buddhist atheist immigrants refugees deaf blind disabled elderly young",
    "personne": "femmes hommes filles garçons homosexuels lesbiennes noirs blancs asiatiques africains arabes juifs musulmans chrétiens hindous bouddhistes athées immigrés réfugiés sourds aveugles handicapés",
    "mensch": "frauen männer mädchen jungen schwule lesben schwarze weiße asiaten afrikaner araber juden muslime christen hindus buddhisten atheisten einwanderer flüchtlinge gehörlose blinde behinderte",
    "persona": "mujeres hombres niñas niños homosexuales lesbianas negros blancos asiáticos africanos árabes judíos musulmanes cristianos hindúes budistas ateos inmigrantes refugiados sordos ciegos discapacitados",
}
_GROUPS = {term: (neutral, terms.split()) for neutral, terms in IDENTITY.items() for term in terms.split()}
_TERM = re.compile(r"(?<![^\W\d_])(" + "|".join(sorted(map(re.escape, _GROUPS), key=len, reverse=True)) + r")(?![^\W\d_])", re.IGNORECASE)


def swapped(text: str) -> list[str]:
    """The text with each identity term made another one, and with each made neutral; none if it has no such term."""
    if not _TERM.search(text):
        return []

    def other(m: re.Match) -> str:
        terms = _GROUPS[m[0].lower()][1]
        return terms[(terms.index(m[0].lower()) + 7) % len(terms)]

    return [_TERM.sub(other, text), _TERM.sub(lambda m: _GROUPS[m[0].lower()][0], text)]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature), distinct and sorted, and the number of letter runs of each row."""
    rows, n = len(offsets) - 1, len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    row, start, end = runs(data, offsets, LETTER)
    sums = running(LOWER[data])
    mask = U((1 << BITS) - 1)
    keys = [row << BITS | (span_hash(sums, start, end) & mask).astype(np.int64)]
    for k in PREFIXES:
        long = end - start > k
        keys.append(row[long] << BITS | (mix64(span_hash(sums, start[long], start[long] + k) + U(k)) & mask).astype(np.int64))
    keys = np.unique(np.concatenate(keys))
    return keys >> BITS, keys & ((1 << BITS) - 1), np.bincount(row, minlength=rows)


class Model(NamedTuple):
    weights: np.ndarray  # of all 2**BITS features, float32
    bias: float
    length: float  # weight of the logarithm of the number of letter runs
    threshold: float = 0.3

    def score(self, row: np.ndarray, feature: np.ndarray, runs: np.ndarray) -> np.ndarray:
        z = np.bincount(row, self.weights[feature], minlength=len(runs)) + self.bias + self.length * np.log1p(runs) / 10
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _counts(batches):
    """Documents of each label that have each feature, of one task."""
    seen, docs = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in slices(batch.column(0)):
            n = len(part.offsets) - 1
            own = np.clip(y[part.first : part.first + n], 0, 1)
            row, feature, _ = features(part.data, part.offsets)
            np.add.at(seen, (own[row], feature), 1)
            docs += np.bincount(own, minlength=2)
    at = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1], at))), pa.array(np.concatenate((docs[:1], seen[0, at]))), pa.array(np.concatenate((docs[1:], seen[1, at])))], names=["feature", "n0", "n1"]
    )


def fit(rows: DataFrame, pairing: float = PAIRING) -> Model:
    """Fit on ``text, y``: a bounded table of labelled documents."""
    # a task lists every feature of its documents, toxic or not: at most 2**BITS. The saved rows are few, and so are their tasks
    counted = rows.select("text", "y").mapInArrow(tidy(_counts), "feature long, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = counted.where(f"feature < 0 or n1 >= {LEAST_DOCS}").toPandas()
    total = counted[counted.feature < 0][["n0", "n1"]].sum()
    t0, t1 = float(total.n0), float(total.n1)
    weights = np.zeros(1 << BITS, np.float32)
    if not t1 or not t0:
        return Model(weights, 20.0 if t1 else -20.0, 0.0)
    f = counted[counted.feature >= 0]
    n0, n1 = f.n0.to_numpy(float), f.n1.to_numpy(float)
    e1 = (n0 + n1) * t1 / (t0 + t1)
    e0 = n0 + n1 - e1
    g2 = 2 * (n1 * np.log(np.maximum(n1, 1e-9) / e1) + np.where(n0 > 0, n0 * np.log(np.maximum(n0, 1e-9) / e0), 0))
    good = (n1 / t1 >= LEAST_RATIO * (n0 + 0.5) / t0) & (g2 >= LEAST_G2)
    order = np.lexsort((f.feature.to_numpy(), -g2))
    chosen = f.feature.to_numpy()[order[good[order]]]
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def project(batches):
        for batch in batches:
            text = batch.column(0).fill_null("").to_pylist()
            y = batch.column(1).to_pylist()
            cases = [(t, label, i, 0) for i, (t, label) in enumerate(zip(text, y, strict=True))]
            cases += [(s, label, i, 1) for t, label, i, _ in list(cases) for s in swapped(t)]
            texts, out = pa.array([c[0] for c in cases], pa.string()), []
            for part in slices(texts):
                row, feature, runs = features(part.data, part.offsets)
                at = place[feature]
                row, at = row[at >= 0], at[at >= 0]
                ends = np.searchsorted(row, np.arange(len(runs) + 1))
                out += [(at[a:b].tolist(), int(r)) for a, b, r in zip(ends[:-1], ends[1:], runs, strict=True)]
            by = {c[2]: o for c, o in zip(cases, out, strict=True) if not c[3]}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.list_(pa.int32())),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([c[1] for c in cases], pa.int32()),
                    pa.array([by[c[2]][0] if c[3] else None for c in cases], pa.list_(pa.int32())),
                ],
                names=["at", "runs", "y", "origin"],
            )

    got = rows.select("text", "y").mapInArrow(project, "at array<int>, runs long, y int, origin array<int>").toPandas()
    # in one order, so that sums of floats are the same however the rows are dealt
    got = got.iloc[sorted(range(len(got)), key=lambda i: (got.runs[i], got.y[i], list(got["at"][i]), got.origin[i] is not None and list(got.origin[i]) or []))]
    real = got[got.origin.isna()]
    pairs = got[~got.origin.isna()]

    def sparse(lists):
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, np.int64) for x in lists]]), len(sizes)

    (r, c, n), y = sparse(real["at"].tolist()), np.clip(real.y.to_numpy(float), 0, 1)
    length = np.log1p(real.runs.to_numpy(float)) / 10
    (pr, pc, m), (qr, qc, _) = sparse(pairs["at"].tolist()), sparse(pairs.origin.tolist())
    k = len(chosen)
    w, moment, speed = np.zeros(k + 2), np.zeros(k + 2), np.zeros(k + 2)
    w[k] = np.log((y.sum() + 1) / (n - y.sum() + 1))
    for step in range(1, 401):
        z = np.bincount(r, w[c], minlength=n) + w[k] + w[k + 1] * length
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.concatenate((np.bincount(c, d[r], minlength=k), [d.sum(), (d * length).sum()]))
        g[:k] += 2e-5 * w[:k]
        if m:
            change = np.bincount(pr, w[pc], minlength=m) - np.bincount(qr, w[qc], minlength=m)
            g[:k] += 2 * pairing / m * (np.bincount(pc, change[pr], minlength=k) - np.bincount(qc, change[qr], minlength=k))
        moment = 0.9 * moment + 0.1 * g
        speed = 0.99 * speed + 0.01 * g * g
        w -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-8)
    weights[chosen] = w[:k]
    return Model(weights, float(w[k]), float(w[k + 1]))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "tox_score") -> DataFrame:
    """``keep`` columns and the score, as ``name``, of every document, from one scan; null and empty texts are scored as no words."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # 4 MB, whatever the input

    def scan(batches):
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch.column(batch.num_columns - 1)):
                n = len(part.offsets) - 1
                s = own.score(*features(part.data, part.offsets))
                yield pa.RecordBatch.from_arrays([c.slice(part.first, n) for c in batch.columns[:-1]] + [pa.array(s)], names=[*keep, name])

    (text,) = fresh(docs, "_text")
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs["text"].alias(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(tidy(scan), f"{schema}, `{name}` double")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _fitted(docs: DataFrame, labels: DataFrame) -> Model:
    s = Scratch(docs.sparkSession, "toxicity")
    return fit(labelled.sample(docs, labels, "toxic", ~held_out(F.col("doc_id")), s))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Fitted on at most about ``labelled.FIT_ROWS`` labelled documents whose
    crc32(doc_id) mod 4 is not 2; the model is the same however the rows are dealt to tasks.
    Texts that are null, empty or without letters get the score of a text without
    features; a text of any length is scored whole, each feature counting once.
    Without labelled rows of both kinds every score is near 0 (or near 1 if all are
    toxic). Of a document labelled twice one label counts; repeated rows give equal
    rows, a null doc_id is kept with a null ``held_out`` and never learned from.
    An empty table gives no rows; other columns don't matter, whatever their names.
    """
    model = _fitted(docs, labels)
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= model.threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """The documents that the classifier lets pass, with all their columns. Texts to learn from are those of ``fit_on``, else of ``docs``.

    Nulls, empty and very long texts, repeated rows and empty tables are as in ``toxicity``;
    a column of any name stays.
    """
    model = _fitted(docs if fit_on is None else fit_on, labels)
    (name,) = fresh(docs, "tox_score")
    return score(docs, model, tuple(docs.columns), name).where(F.col(f"`{name}`") < model.threshold).drop(name)
