"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words. Benchmark passages become TF-IDF vectors, whose
IDF counts the passages of the whole corpus, and randomised SVDs of blocks of at
most ``RANK`` of them, their sums formed in the tasks, give latent spaces. Stretches
of the documents that hold enough of a passage's rarer words are projected; pairs
that hold enough of its weight are candidates, which the longest common subsequence
of words and a check of the answer then confirm or reject. Both tests before it
follow from what it asks for (so many words of the passage must be there), so they
lose nothing: no pair is left out for a low cosine, which is only reported.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, fresh
from .textarray import ALNUM, LOWER, U, running, runs, slices, span_hash, tidy

WINDOW, STRIDE = 64, 32
SCALES = (8, 16, 32, 64)  # windows of documents: a passage is searched in the smallest that takes it
DIMENSIONS = 1 << 15  # of the hashed TF-IDF space
KNOWN_BITS = 1 << 22  # of the table that tells benchmark words from others
RANK, EXTRA = 256, 16
LCS, LCS_WITH_ANSWER = 0.7, 0.5
EXACT_BELOW = 8  # words of an item that must be contained word by word
ANSWER_WORDS = 8
COMMONEST = 0.25  # share of a passage's words that the first test leaves out, the commonest
CELLS = 1 << 21  # numbers that the first test holds at once
#: Benchmark passages held in a task at once; more are taken in turns, each a scan.
AT_ONCE = 4096

_ANSWER = re.compile(r"\banswer\s*:", re.IGNORECASE)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each run of letters and digits, lower-cased A-Z."""
    row, start, end = runs(data, offsets, ALNUM)
    return row, span_hash(running(LOWER[data]), start, end) if len(row) else np.zeros(0, U)


def windows(row: np.ndarray, rows: int, size: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end token of each window; a row's last window ends with the row."""
    count = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    n = np.where(count > 0, 1 + np.maximum(0, -(-(count - size) // stride)), 0)
    own = np.repeat(np.arange(rows), n)
    step = np.arange(len(own)) - np.repeat(np.concatenate(([0], np.cumsum(n)))[:-1], n)
    begin = first[own] + step * stride
    return own, begin, np.minimum(begin + size, first[own] + count[own])


def expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window and token index of each token of each window."""
    size = end - begin
    window = np.repeat(np.arange(len(size)), size)
    return window, np.arange(len(window)) - np.repeat(np.concatenate(([0], np.cumsum(size)))[:-1], size) + begin[window]


def distinct(window: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(window * DIMENSIONS + feature)
    key = key[np.diff(key, prepend=-1) > 0]
    return key // DIMENSIONS, key % DIMENSIONS


def feature_of(h: np.ndarray) -> np.ndarray:
    return (h >> U(20) & U(DIMENSIONS - 1)).astype(np.int64)


def known_place(h: np.ndarray) -> np.ndarray:
    return (h & U(KNOWN_BITS - 1)).astype(np.int64)


def lcs(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, by whole-word bit operations on one long integer."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        if m := where.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _sum_matrices(df: DataFrame, make, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of what ``make`` gives for each batch: one matrix a task reaches the driver, of at most 8."""

    def scan(batches):
        total = np.zeros(shape, np.float32)
        for batch in batches:
            total += make(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["m"])

    parts = [np.frombuffer(m, np.float32).reshape(shape) for (m,) in df.coalesce(2).mapInArrow(scan, "m binary").collect()]
    return sum(parts, np.zeros(shape, np.float32))


def rows_of(batch: pa.RecordBatch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Unit TF-IDF rows of stored passages: row, feature, weight."""
    lists = batch.column("words")
    sizes = np.diff(lists.offsets.to_numpy())
    own = np.repeat(np.arange(len(sizes)), sizes)
    row, feature = distinct(own, feature_of(lists.flatten().to_numpy().view(U)))
    w = idf[feature]
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(sizes)))
    return row, feature, w / np.maximum(norm[row], 1e-9), len(sizes)


def _times(row, feature, w, n, right: np.ndarray) -> np.ndarray:
    """Rows of a sparse matrix times ``right``; ``row`` is sorted."""
    out = np.zeros((n, right.shape[1]), np.float32)
    if len(row):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[first]] = np.add.reduceat(right[feature] * w[:, None].astype(np.float32), first, axis=0)
    return out


def randomised_svd(passages: DataFrame, idf: np.ndarray, used: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors (features, rank) of the TF-IDF matrix whose rows are ``passages``.

    Halko, Martinsson and Tropp 2011 with one power step. Columns are those of features that occur, ``used``.
    """
    place = np.zeros(DIMENSIONS, np.int64)
    place[used] = np.arange(len(used))
    width = min(rank + EXTRA, len(used))

    def through(basis: np.ndarray):  # A^T A basis
        def make(batch):
            row, feature, w, n = rows_of(batch, idf)
            y = _times(row, place[feature], w, n, basis)
            out = np.zeros((len(used), width), np.float32)
            np.add.at(out, place[feature], y[row] * w[:, None].astype(np.float32))
            return out

        return make

    start = np.random.default_rng(7).standard_normal((len(used), width), np.float32)
    basis = start
    for _ in range(2):
        basis, _ = np.linalg.qr(_sum_matrices(passages, through(basis), (len(used), width)))
        basis = basis.astype(np.float32)
    # on the found range, A^T A is small: its eigenvectors turn the basis into singular vectors
    small = basis.T @ _sum_matrices(passages, through(basis), (len(used), width))
    values, turn = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-6 * max(values.max(), 1e-9)]
    out = np.zeros((DIMENSIONS, len(keep)), np.float32)
    out[used] = basis @ turn[:, keep]
    return out


def _passages(benchmark: DataFrame) -> DataFrame:
    """``item_id, part, words, answer`` of benchmark windows."""

    def scan(batches):
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1).fill_null("").to_pylist()
            out = []
            for item, text in zip(ids.to_pylist(), texts, strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                _, h = tokens(data, np.array([0, len(data)]))
                m = _ANSWER.search(text)
                tail = np.frombuffer(text[m.end() :].encode(), np.uint8) if m else None
                answer = tokens(tail, np.array([0, len(tail)]))[1] if m else h[-ANSWER_WORDS:]
                own, begin, end = windows(np.zeros(len(h), np.int64), 1)
                out += [(item, k, h[a:b].view(np.int64), answer.view(np.int64)) for k, (a, b) in enumerate(zip(begin, end, strict=True))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64())), pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                names=["item_id", "part", "words", "answer"],
            )

    return benchmark.select("item_id", "text").mapInArrow(scan, "item_id long, part long, words array<long>, answer array<long>")


def _frequencies(docs: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """Passages of the corpus that have each benchmark feature, and all its passages. A task sends its counts packed."""

    def scan(batches):
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in slices(batch.column(0)):
                row, h = tokens(part.data, part.offsets)
                own, begin, end = windows(row, len(part.offsets) - 1)
                n += len(own)
                at = np.flatnonzero(known[known_place(h)])
                # a token lies in at most two windows
                window, token = expand(np.searchsorted(at, begin), np.searchsorted(at, end))
                _, feature = distinct(window, feature_of(h[at[token]]))
                df += np.bincount(feature, minlength=DIMENSIONS)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((np.flatnonzero(df), [-1]))), pa.array(np.concatenate((df[df > 0], [n])))], names=["feature", "n"])

    got = docs.select("text").mapInArrow(tidy(scan), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIMENSIONS, np.int64)
    is_feature = got.feature >= 0
    df[got.feature[is_feature]] = got.n[is_feature]
    return df, int(got.n[~is_feature].sum())


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs, answer`` of every document and benchmark item that it contains, also reworded.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``;
    other columns don't matter, whatever their names. Null and empty texts match nothing, repeated rows
    give one row, rows with one doc_id are one document, a null doc_id is a value like any other, an item
    without an id is left out, empty tables give no rows. Texts of any length are searched whole, window by
    window; each must fit in a row. Items of fewer than 8 words must be contained word by word. An item's words are looked for in a window (of ``SCALES``) and as many
    words as the item has on either side. ``lcs`` is the share of the passage's words that stand in the document
    in order, ``answer`` whether the words after "answer:", else the last eight, do.
    """
    s = Scratch(spark, "leaks")
    passages = s.save(_passages(benchmark.where("item_id is not null")), "passages")
    known = np.zeros(KNOWN_BITS, bool)
    known[passages.select(F.explode("words").alias("w")).select((F.col("w").bitwiseAND(KNOWN_BITS - 1)).alias("w")).distinct().toPandas().w.to_numpy(int)] = True
    df, total = _frequencies(docs, known)
    idf = np.log((total + 1) / (df + 1.0)).astype(np.float32) + 0.1
    shift = 20  # of feature_of
    used = np.sort(passages.select(F.explode("words").alias("w")).select(F.expr(f"shiftrightunsigned(w, {shift}) & {DIMENSIONS - 1}").alias("w")).distinct().toPandas().w.to_numpy(int))
    if not len(used):
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, answer boolean")
    unknown = float(np.median(idf[used]))
    turns = max(1, -(-passages.count() // AT_ONCE))
    found = None
    for turn in range(turns):
        held = passages.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(turns)) == turn).orderBy("item_id", "part").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        size = pc.list_value_length(held.column("words")).to_numpy()
        scale = np.array(SCALES)[np.searchsorted(SCALES, size)]
        blocks = []
        for one in sorted(set(scale.tolist())):
            at = np.flatnonzero(scale == one)
            blocks += [_block(spark, held.take(at[k : k + RANK]).combine_chunks(), one, idf) for k in range(0, len(at), RANK)]
        pairs = _search(spark, docs, blocks, idf, known, unknown)
        found = pairs if found is None else found.union(pairs)
    best = s.save(found, "found").groupBy("doc_id", "item_id")
    return best.agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


class Block(NamedTuple):
    """At most ``RANK`` passages of one scale, with their own latent space."""

    scale: int
    place: np.ndarray  # of each feature in the basis; 0 is none
    basis: np.ndarray  # a row of zeros, then one a feature of the block
    latent: np.ndarray  # of each passage, projected unit rows
    missed: np.ndarray  # norm of what the projection leaves of each unit row
    weight: np.ndarray  # least x . row of any stretch x with enough of the passage's words
    first: np.ndarray  # of the entries of each feature, by place: passages it is a rarer word of
    entry: np.ndarray  # passage of each entry
    times: np.ndarray  # words of the passage that the entry stands for
    need: np.ndarray  # least number of those rarer words that must be there
    counts: np.ndarray  # by place: the words of each passage, then the different ones of its answer
    enough: np.ndarray  # words of each passage that must be there, that suffice without its answer, and of the answer
    items: list
    words: list
    answers: list


def _block(spark: SparkSession, table: pa.Table, scale: int, idf: np.ndarray) -> Block:
    batch = table.to_batches()[0]
    row, feature, w, n = rows_of(batch, idf)
    used = np.unique(feature)
    whole = randomised_svd(spark.createDataFrame(table), idf, used, RANK)
    latent = _times(row, feature, w, n, whole)
    words, answers = batch.column("words").to_pylist(), batch.column("answer").to_pylist()
    said = [np.unique(feature_of(np.array(a, np.int64).view(U))) for a in answers]
    used = np.union1d(used, np.concatenate(said))
    place = np.zeros(DIMENSIONS, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    counts, enough = np.zeros((len(used) + 1, -(-2 * n // 8) * 8), np.uint8), np.zeros((3, n), np.int64)
    entries, need, least = [], np.zeros(n, np.int64), np.zeros(n)
    for q, item in enumerate(words):
        got, times = np.unique(feature_of(np.array(item, np.int64).view(U)), return_counts=True)
        must = len(item) if len(item) < EXACT_BELOW else math.ceil(LCS_WITH_ANSWER * len(item) - 1e-9)
        counts[place[got], q] = times
        counts[place[said[q][:255]], n + q] = 1
        enough[:, q] = must, max(must, math.ceil(LCS * len(item) - 1e-9)), len(said[q][:255]) or 256
        order = np.argsort(idf[got], kind="stable")  # commonest first
        got, times = got[order], times[order]
        rarer = np.cumsum(times) > COMMONEST * len(item)
        need[q] = must - times[~rarer].sum()
        entries += [(place[f], q, t) for f, t in zip(got[rarer], times[rarer], strict=True)]
        # the least weight of words that are ``must`` in number: cheapest first, the last in part
        power = idf[got].astype(float) ** 2
        cheap = np.argsort(power / times, kind="stable")
        before = np.cumsum(times[cheap]) - times[cheap]
        part = np.clip((must - before) / times[cheap], 0, 1)
        least[q] = (power[cheap] * part).sum() / max(math.sqrt(power.sum()), 1e-9)
    entries = np.array(sorted(entries), np.int64).reshape(-1, 3)
    first = np.searchsorted(entries[:, 0], np.arange(len(used) + 2))
    basis = np.concatenate((np.zeros((1, whole.shape[1]), np.float32), whole[used]))
    missed = np.sqrt(np.maximum(0, 1 - (latent.astype(float) ** 2).sum(axis=1)))
    return Block(scale, place, basis, latent, missed, least, first, entries[:, 1], entries[:, 2], need, counts, enough, batch.column("item_id").to_pylist(), words, answers)


def _likely(b: Block, place: np.ndarray, row: np.ndarray, begin: np.ndarray, own: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Window and passage of all pairs with enough rarer words in the window or as far before or after it as it is long.

    Words are counted by cells of half a window, a word in two cells twice: never too few.
    """
    stride = b.scale // 2
    cells = -(-count // stride)
    before = np.concatenate(([0], np.cumsum(cells)))
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.flatnonzero(b.first[place + 1] > b.first[place])
    key = np.unique((before[row[at]] + (at - first[row[at]]) // stride) * len(b.basis) + place[at])
    cell, place = key // len(b.basis), key % len(b.basis)
    which, entry = expand(b.first[place], b.first[place + 1])
    cell, passage, times = cell[which], b.entry[entry], b.times[entry]
    step = before[own] + (begin - first[own]) // stride
    low, high = np.maximum(step - 2, before[own]), np.minimum(step + 4, before[own + 1])
    width = max(1, CELLS // (int(before[-1]) + 1))
    for start in range(0, len(b.need), width):
        end = min(start + width, len(b.need))
        mine = (passage >= start) & (passage < end)
        sums = np.zeros((before[-1] + 1, end - start), np.int32)
        sums[1:] = np.bincount(cell[mine] * (end - start) + passage[mine] - start, times[mine], minlength=before[-1] * (end - start)).reshape(before[-1], end - start)
        np.cumsum(sums, axis=0, out=sums)
        window, q = np.nonzero(sums[high] - sums[low] >= b.need[start:end])
        yield window, q + start


def _search(spark: SparkSession, docs: DataFrame, blocks: list[Block], idf, known, unknown: float) -> DataFrame:
    # at most AT_ONCE passages, for each block the weights of its own features, and the table of known words
    held = spark.sparkContext.broadcast((blocks, idf, known))

    def scan(batches):
        blocks, idf, known = held.value
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for part in slices(batch.column(1)):
                row, h = tokens(part.data, part.offsets)
                if not len(row):
                    continue
                count = np.bincount(row, minlength=len(part.offsets) - 1)
                first = np.concatenate(([0], np.cumsum(count)))
                inside = known[known_place(h)]
                feature = np.where(inside, feature_of(h), 0)
                weight = np.where(inside, idf[feature], np.float32(unknown))
                power = np.concatenate(([0.0], np.cumsum(weight.astype(float) ** 2)))
                for b in blocks:
                    own, begin, end = windows(row, len(count), b.scale, b.scale // 2)
                    for window, q in _likely(b, np.where(inside, b.place[feature], 0), row, begin, own, count):
                        out += _confirmed(b, window, q, ids, part.first, own, begin, end, first, h, inside, feature, idf, power)
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()))], names=["doc_id", "item_id", "cosine", "lcs", "answer"]
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), "doc_id long, item_id long, cosine double, lcs double, answer boolean")


def _words_of(b: Block, begin, end, inside, feature) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and feature of the distinct words of the block's in stretches of tokens."""
    window, token = expand(begin, end)
    mine = inside[token] & (b.place[feature[token]] > 0)
    return distinct(window[mine], feature[token[mine]])


def _confirmed(b: Block, window, q, ids, row_of_slice, own, begin, end, first, h, inside, feature, idf, power) -> list[tuple]:
    out, n = [], len(b.need)
    order = np.argsort(window, kind="stable")
    window, q = window[order], q[order]
    near, back = np.unique(window, return_inverse=True)
    for start in range(0, len(near), 512):
        these = near[start : start + 512]
        pair = slice(*np.searchsorted(back, [start, start + 512]))
        of, item = back[pair] - start, q[pair]
        stretch, hit = _words_of(b, np.maximum(begin[these] - b.scale, first[own[these]]), np.minimum(end[these] + b.scale, first[own[these] + 1]), inside, feature)
        # as many words as the subsequence must have, and those of the answer where it counts
        there = np.zeros((len(these), b.counts.shape[1]), np.uint8)
        if len(stretch):
            at = np.flatnonzero(np.diff(stretch, prepend=-1))
            # eight bytes are added at once: none of the sums passes 255
            there.view(U)[stretch[at]] = np.add.reduceat(b.counts.view(U)[b.place[hit]], at, axis=0)
        must, alone, answer = b.enough[:, item]
        fair = (there[of, item] >= must) & ((there[of, item] >= alone) | (there[of, n + item] >= answer))
        of, item = of[fair], item[fair]
        if not len(of):
            continue
        left, of_left = np.unique(of, return_inverse=True)
        mine = np.isin(stretch, left)
        stretch, hit = np.searchsorted(left, stretch[mine]), hit[mine]
        x, norm = _times(stretch, b.place[hit], idf[hit], len(left), b.basis), np.sqrt(np.bincount(stretch, idf[hit].astype(float) ** 2, minlength=len(left)))
        fair = np.einsum("ij,ij->i", x[of_left], b.latent[item]) >= b.weight[item] * 0.999 - norm[of_left] * (b.missed[item] + 1e-3)
        good = []
        for i, p in zip(these[of[fair]].tolist(), item[fair].tolist(), strict=True):
            words = b.words[p]
            text = h[max(first[own[i]], begin[i] - len(words)) : min(first[own[i] + 1], end[i] + len(words))].view(np.int64).tolist()
            share = lcs(words, text) / len(words)
            if share < LCS_WITH_ANSWER:
                continue
            said = bool(b.answers[p]) and lcs(b.answers[p], text) == len(b.answers[p])
            if len(words) < EXACT_BELOW and (share < 1 or not any(text[j : j + len(words)] == words for j in range(len(text)))):
                continue
            if share >= LCS or said:
                good.append((i, p, share, said))
        if good:
            at = np.array([g[0] for g in good])
            stretch, hit = _words_of(b, begin[at], end[at], inside, feature)
            x = _times(stretch, b.place[hit], idf[hit], len(at), b.basis)
            norm = np.sqrt(power[end[at]] - power[begin[at]]) + 1e-9
            unit = b.latent[[g[1] for g in good]]
            cosine = np.einsum("ij,ij->i", x, unit) / norm / np.maximum(np.linalg.norm(unit, axis=1), 1e-9)
            out += [(ids[row_of_slice + own[i]], b.items[p], float(c), share, said) for (i, p, share, said), c in zip(good, cosine, strict=True)]
    return out


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents whose text holds no benchmark item, with all their columns.

    Rows are judged by their text, whatever their ids: rows of a null doc_id go as others do, and of rows that share
    an id only those go whose own text leaks. Equal texts stay or go together; null and empty texts stay. Texts of any length,
    ties and empty tables are as in ``leaks``.
    """
    by_text = F.when(F.col("text").isNotNull(), F.xxhash64("text"))
    (name,) = fresh(docs, "leaking")
    found = leaks(spark, docs.where("text is not null").select(by_text.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, by_text == F.col(name), "left_anti")
