"""Media columns: payloads stored as content-defined chunks, each distinct chunk once.

A rolling gear hash over the last 32 bytes cuts a payload where its top bits are
zero, so equal passages give equal chunks wherever they stand. Digests that occur
more than once are found by grouping digests alone. A container holds a payload's
ordered chunk list, and the bytes of chunks that stand nowhere else; the bytes of
repeated chunks are in a store, once, and are joined back by digest when read.
Which chunks go to the store is decided in the scan by a filter of fixed size
over the repeated digests; one taken wrongly for repeated is stored all the same.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .textarray import U, Bloom, bloom_of, byte_table, slices, tidy

UNIT = 64  # payloads are padded to a positive multiple of it
LEAST, MOST = 512, 8192  # bytes of a chunk; only a payload's last may have fewer
CUT_BITS = 11  # a cut is expected after 2**CUT_BITS bytes
GEAR = (byte_table(77) >> U(32)).astype(np.uint32)


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % UNIT or (0 if text else UNIT))


def gear(data: np.ndarray) -> np.ndarray:
    """Hash of the last 32 bytes at each byte: sums of shifted table values, doubled five times."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a payload."""
    out, last, n = [], 0, len(data)
    for at in (np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while at - last > MOST:
            last += MOST
            out.append(last)
        if at - last >= LEAST:
            out.append(at)
            last = at
    while n - last > MOST:
        last += MOST
        out.append(last)
    if last < n:
        out.append(n)
    return out


def chunks(payload: bytes) -> list[tuple[bytes, bytes]]:
    """Digest and bytes of each chunk in order."""
    data, out, last = np.frombuffer(payload, np.uint8), [], 0
    for end in cuts(data):
        part = payload[last:end]
        out.append((hashlib.blake2b(part, digest_size=20).digest(), part))
        last = end
    return out


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _manifest(parts: list[tuple[bytes, bytes]]) -> bytes:
    """The chunk list as it is stored: digest and length of each chunk in order."""
    return b"".join(d + len(p).to_bytes(4, "big") for d, p in parts)


def _entries(manifest: bytes) -> list[tuple[bytes, int]]:
    return [(manifest[at : at + 20], int.from_bytes(manifest[at + 20 : at + ENTRY], "big")) for at in range(0, len(manifest), ENTRY)]


ENTRY = 24
#: Digests that a task remembers to have emitted, so that it emits a chunk seldom twice.
REMEMBERED = 1 << 16

CONTAINER = "doc_id long, n_bytes long, name binary, size long, manifest binary, stored array<boolean>, own binary"
_CONTAINER_TYPES = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.bool_()), pa.binary())


def _texts(batch: pa.RecordBatch):
    """Row and bytes of the texts of a batch's last column, about half a megabyte at a time: what a task holds and sends doesn't grow with its batches."""
    for part in slices(batch.column(batch.num_columns - 1)):
        yield part.first, [part.data[a:b].tobytes() for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True)]


def _table(rows: list[tuple], schema: str, types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=[f.split()[0] for f in schema.split(", ")])


def _digests(batches):
    """Digests of a task's chunks, the key that filters have of each, and how often it occurs, slice by slice."""
    for batch in batches:
        for _, texts in _texts(batch):
            times = Counter(d for text in texts for d, _ in chunks(padded(text)))
            yield _table([(d, _short(d), n) for d, n in times.items()], "digest binary, key long, n long", (pa.binary(), pa.int64(), pa.int64()))


def _containers(repeated: Bloom):
    def scan(batches):
        for batch in batches:
            for first, texts in _texts(batch):
                ids, out = batch.column(0).slice(first, len(texts)).to_pylist(), []
                for doc_id, text in zip(ids, texts, strict=True):
                    payload = padded(text)
                    parts = chunks(payload)
                    stored = repeated.has(np.array([_short(d) for d, _ in parts], np.int64).view(U)).tolist()
                    own = b"".join(p for (_, p), away in zip(parts, stored, strict=True) if not away)
                    out.append((doc_id, len(text), hashlib.sha256(payload).digest(), len(payload), _manifest(parts), stored, own))
                yield _table(out, CONTAINER, _CONTAINER_TYPES)

    return scan


def _stored(repeated: Bloom):
    def scan(batches):
        told: set[bytes] = set()
        for batch in batches:
            for _, texts in _texts(batch):
                found: dict[bytes, bytes] = {}
                for text in texts:
                    parts = [(d, p) for d, p in chunks(padded(text)) if d not in told]
                    away = repeated.has(np.array([_short(d) for d, _ in parts], np.int64).view(U)).tolist()
                    found.update(x for x, y in zip(parts, away, strict=True) if y)
                told = told | found.keys() if len(told) < REMEMBERED else set(found)
                yield _table(list(found.items()), "digest binary, bytes binary", (pa.binary(), pa.binary()))

    return scan


def store(spark: SparkSession, docs: DataFrame, s: Scratch) -> tuple[DataFrame, DataFrame]:
    """Write the containers and the chunk store of ``docs`` (``doc_id, text``); returns both as tables."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = source.select("text").mapInArrow(tidy(_digests), "digest binary, key long, n long").groupBy("digest", "key").agg(F.sum("n").alias("n")).where("n > 1")
    wanted = bloom_of(s.save(counted.select("key"), "repeated"), "key")
    containers = s.save(source.mapInArrow(tidy(_containers(wanted)), CONTAINER), "containers")
    kept = source.select("text").mapInArrow(tidy(_stored(wanted)), "digest binary, bytes binary").groupBy("digest").agg(F.first("bytes").alias("bytes"))
    return containers, s.save(kept, "chunks")


def features(payload: bytes, lengths: list[int]) -> str:
    """Statistics of the 8-bit samples and of the chunks, as ``name=value`` pairs."""
    x = np.frombuffer(payload, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() + 0.0
    return f"samples={len(x)};mean={x.mean():.4f};rms={np.sqrt((x.astype(float) ** 2).mean()):.4f};peak={x.max()};entropy={entropy:.4f};chunks={len(lengths)}"


RESULT = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, intact boolean"
_RESULT_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())


def _result(n_bytes: int, name: bytes, manifest: bytes, parts: list[bytes]) -> tuple:
    payload, entries = b"".join(parts), _entries(manifest)
    good = len(parts) == len(entries) and all(len(p) == n and hashlib.blake2b(p, digest_size=20).digest() == d for p, (d, n) in zip(parts, entries, strict=True))
    sha = hashlib.sha256(payload).digest()
    # what is stored of it: its chunk list, then the chunks that this lists
    media = hashlib.sha256(manifest + payload).hexdigest()
    return n_bytes, len(payload), sha.hex(), zlib.crc32(payload[-UNIT:]), len(manifest) + len(payload), media, features(payload, [n for _, n in entries]), good and sha == name


def _rows(batch: pa.RecordBatch, *names: str):
    """Rows of a batch, one at a time."""
    columns = [batch.column(n) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def _read_own(batches):
    """Containers that hold all their chunks."""
    for batch in batches:
        rows = []
        for doc_id, n_bytes, name, manifest, own in _rows(batch, "doc_id", "n_bytes", "name", "manifest", "own"):
            at, parts = 0, []
            for _, n in _entries(manifest):
                parts.append(own[at : at + n])
                at += n
            rows.append((doc_id, *_result(n_bytes, name, manifest, parts)))
        yield _table(rows, f"doc_id long, {RESULT}", (pa.int64(), *_RESULT_TYPES))


def _read_joined(batches):
    """Containers with the chunks that the store had for them, ``got``: (place, bytes) in any order."""
    for batch in batches:
        rows = []
        for n_bytes, name, manifest, stored, own, found in _rows(batch, "n_bytes", "name", "manifest", "stored", "own", "got"):
            at, parts, got = 0, [], {x["place"]: x["bytes"] for x in found}
            for k, ((_, n), away) in enumerate(zip(_entries(manifest), stored, strict=True)):
                if away:
                    parts.append(got.get(k, b""))
                else:
                    parts.append(own[at : at + n])
                    at += n
            rows.append((name, *_result(n_bytes, name, manifest, parts)))
        yield _table(rows, f"name binary, {RESULT}", (pa.binary(), *_RESULT_TYPES))


def restore(containers: DataFrame, store: DataFrame, s: Scratch) -> DataFrame:
    """``doc_id`` and RESULT of every container, computed from the bytes read back."""
    away = F.array_contains("stored", True)
    alone = containers.where(~away).select("doc_id", "n_bytes", "name", "manifest", "own").mapInArrow(tidy(_read_own), f"doc_id long, {RESULT}")
    # payloads with stored chunks are put together once for all documents that have them
    mixed = containers.where(away)
    kinds = s.save(mixed.groupBy("name", "n_bytes").agg(*[F.first(c).alias(c) for c in ("manifest", "stored", "own")]), "kinds")
    each = kinds.select("name", "n_bytes", F.posexplode("stored").alias("place", "away"), "manifest").where("away")
    wanted = each.select("name", "n_bytes", "place", F.substring("manifest", F.col("place") * ENTRY + 1, F.lit(20)).alias("digest"))
    got = wanted.join(store, "digest").groupBy("name", "n_bytes").agg(F.collect_list(F.struct("place", "bytes")).alias("got"))
    whole = kinds.join(got, ["name", "n_bytes"]).mapInArrow(tidy(_read_joined), f"name binary, {RESULT}")
    whole = s.save(whole, "whole")
    return alone.union(mixed.select("doc_id", "name", "n_bytes").join(whole, ["name", "n_bytes"]).select("doc_id", *[f.split()[0] for f in RESULT.split(", ")]))


def media(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, intact``.

    The payload is the text in UTF-8 (null: none) with bytes 0 up to a positive multiple
    of 64. What is stored of it is its chunk list, in its container, and its chunks, there or
    in the store: ``media_bytes`` and ``media_sha256`` are of these stored bytes as read back,
    the list and then its chunks, so equal texts have equal values wherever their chunks lie.
    ``intact`` says that every chunk and the whole have the digests they were stored under.
    A payload of any length is cut, stored and hashed whole; it must fit in a row. Empty and
    null texts are 64 zeros. Rows may repeat and ids tie or be null: each row has its own result,
    equal for equal texts. An empty table gives no rows; other columns don't matter, whatever their names.
    """
    s = Scratch(spark, "media")
    return restore(*store(spark, docs, s), s)
