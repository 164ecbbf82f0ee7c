"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Labelled rows that a classifier is fitted on; more than twice as many are thinned by hashes.
FIT_ROWS = 12_000


def share(*values: Column, salt: int) -> Column:
    """A fraction in [0, 1) that depends on the values only."""
    return F.pmod(F.xxhash64(*values, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, s: Scratch, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, text, y`` of labelled documents that ``learn`` (of doc_id) allows: all, if they are ``2 * rows`` at most, else about ``rows`` of them.

    The thinned labels are at most a few times ``rows`` short rows, so they are
    broadcast, and the documents are read in one scan of its full width. Equal rows count once, where
    they are read already. The sample is saved: what is fitted on it never scans the documents again. An id
    may have texts without bound; these are thinned by hashes of their own, once they are saved.
    """
    own = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")).where(learn)
    n = own.count()
    thin = own.where(share(F.col("doc_id"), salt=17) < rows / max(n, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    met = docs.select("doc_id", "text").join(F.broadcast(thin), "doc_id")
    once = met.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    found = s.save(once, f"sample-{label}")
    m = found.count()
    fewer = found.where(share(F.col("doc_id"), F.col("h"), salt=19) < rows / m) if m > 2 * rows else found
    return fewer.select("doc_id", "text", "y")
