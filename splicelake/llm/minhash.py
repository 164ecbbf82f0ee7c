"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find.

SuperMinHash (Ertl 2017) gives every element one random permutation of the m
signature slots and one fraction for each of its steps; slot s becomes the
smallest ``step + fraction`` of the elements whose permutation puts s at that
step. The steps of one element are correlated, which lowers the variance, and a
step can be skipped for a document once all its slots are filled by earlier
steps. Here step j runs for all elements of a slice of documents at once, and
documents whose slots are full leave before the next step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, fresh
from .textarray import U, Bloom, bloom_of, mix64, shingles, slices, tidy, words

SLOTS = 128
ROWS = 5  # of a band
BANDS = 25
#: Share of equal slots below which two sets don't reach 0.8: five standard deviations.
SIGHT = 0.62
#: Buckets up to this size are compared in full at once; larger ones around centres first.
SMALL = 16


def superminhash(row: np.ndarray, element: np.ndarray, rows: int, m: int = SLOTS) -> np.ndarray:
    """Signatures (rows, m) of 64-bit elements; ``row`` is sorted. Rows without elements keep the largest value."""
    full = np.iinfo(U).max
    out = np.full(rows * m, full, U)
    x, r, steps = element, row, []
    present = np.zeros(rows, bool)
    present[row] = True
    with np.errstate(over="ignore"):
        for j in range(m):
            if not len(x):
                break
            u = mix64(x + U(j + 1) * U(0x9E3779B97F4A7C15))
            k = (j + (((u >> U(32)) * U(m - j)) >> U(32)).astype(np.int64)).astype(np.int16)
            slot = k.copy()
            for t in range(j - 1, -1, -1):  # follow the swaps of the earlier steps back to the slot
                slot = np.where(slot == steps[t], np.int16(t), slot)
            steps.append(k)
            np.minimum.at(out, r * m + slot, (U(j) << U(32)) | (u & U(0xFFFFFFFF)))
            open_rows = (out.reshape(rows, m) == full).any(axis=1) & present
            stay = open_rows[r]
            if not stay.all():
                x, r, steps = x[stay], r[stay], [s[stay] for s in steps]
    return out.reshape(rows, m)


def signatures(docs: DataFrame, k: int, m: int = SLOTS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, sig, buckets`` of documents; (n_shingles, d1, d2) names a set."""

    def scan(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for part in slices(text):
                n = len(part.offsets) - 1
                row, value = shingles(words(part.data, part.offsets), n, k)
                count = np.bincount(row, minlength=n)
                with np.errstate(over="ignore"):
                    first = np.concatenate(([0], np.cumsum(count)))
                    sums = [np.concatenate((np.zeros(1, U), np.cumsum(mix64(value + U(s))))) for s in (11, 23)]
                    d1, d2 = (s[first[1:]] - s[first[:-1]] for s in sums)
                    sig = superminhash(row, value, n, m)
                    band = np.zeros((n, bands), U)
                    for b in range(bands):
                        h = np.full(n, b + 1, U)
                        for c in range(b * rows, (b + 1) * rows):
                            h = mix64(h * U(0x9E3779B97F4A7C15) + sig[:, c])
                        band[:, b] = h
                short = (mix64(sig) & U(0xFFFF)).astype(np.uint16)
                some = count > 0
                buckets = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)), pa.array(band[some].ravel().view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.first, n).cast(pa.int64()),
                        pa.array(count.astype(np.int64)),
                        pa.array(d1.view(np.int64)),
                        pa.array(d2.view(np.int64)),
                        pa.array([x.tobytes() for x in short], pa.binary()),
                        buckets,
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig", "buckets"],
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), "doc_id long, n_shingles long, d1 long, d2 long, sig binary, buckets array<long>")


def shingle_sets(docs: DataFrame, k: int, wanted: Bloom) -> DataFrame:
    """``doc_id, shingles`` of the documents that the filter lets through, from a scan without a shuffle."""

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(0)
            keep = wanted.has(ids.to_numpy(zero_copy_only=False).view(U)) & ~np.asarray(batch.column(0).is_null())
            if not keep.any():
                continue
            ids, text = ids.filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))
            for part in slices(text):
                n = len(part.offsets) - 1
                row, value = shingles(words(part.data, part.offsets), n, k)
                at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(at), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(part.first, n), sets], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), "doc_id long, shingles array<long>")


def _alike(pairs: DataFrame) -> DataFrame:
    """Equal slots of the two signatures ``sa`` and ``sb``, counted in Arrow batches."""

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            keep = pa.array((a == b).mean(axis=1) >= SIGHT)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(tidy(count), "a long, b long")


class Linker:
    """Finds, among pairs of set representatives, those that reach the similarity."""

    def __init__(self, docs: DataFrame, reps: DataFrame, k: int, num: int, den: int, scratch: Scratch):
        self.docs, self.reps, self.k, self.num, self.den, self.scratch = docs, reps, k, num, den, scratch
        self.round = 0

    def links(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of representatives whose full shingle sets have num/den of their union in common."""
        self.round += 1
        at, s = f"links{self.round}", self.scratch
        sig = self.reps.select("rep", "sig", "n_shingles")
        near = s.save(
            _alike(
                pairs.join(sig.toDF("a", "sa", "na"), "a")
                .join(sig.toDF("b", "sb", "nb"), "b")
                .where(F.least("na", "nb") * self.den >= F.greatest("na", "nb") * self.num)
            ),
            f"{at}-near",
        )
        ends = s.save(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), f"{at}-ends")
        sets = s.save(shingle_sets(self.docs, self.k, bloom_of(ends, "doc_id")).join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id"]), f"{at}-sets")
        common = F.size(F.array_intersect("x", "y"))
        out = s.save(
            near.join(sets.toDF("a", "x"), "a")
            .join(sets.toDF("b", "y"), "b")
            .withColumn("c", common)
            .where(F.col("c") * self.den >= (F.size("x") + F.size("y") - F.col("c")) * self.num)
            .select("a", "b"),
            f"{at}-links",
        )
        for x in ("near", "ends", "sets"):
            s.drop(f"{at}-{x}")
        return out


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns don't matter.
    Two documents are linked if their sets of ``k``-word shingles have at least
    ``similarity`` (a fraction of 0.8 or more) of their union in common; a component is what links reach,
    its id the smallest doc_id. Texts that are null or without words have an empty
    set and are linked with nothing. Repeated rows give repeated equal rows; rows
    with one doc_id and different texts are one document, for which either text may stand when links are looked for.
    A row without a doc_id is its own component, null. An empty table gives no rows. The set of a
    text of any length is whole; it must fit in a row.

    Equal sets become one class before anything is paired. The classes of a bucket
    are compared around its most widely shared member; what that leaves in more
    than one component is compared pair by pair between components, so no bucket
    is capped and a group of copies costs as many comparisons as it has members.
    """
    num, den = similarity
    s = Scratch(spark, "minhash")
    sigs = s.save(signatures(docs, k), "sigs")
    key = ["n_shingles", "d1", "d2"]
    classes = s.save(
        sigs.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes"
    )
    members = sigs.select("doc_id", *key).where("n_shingles > 0 and doc_id is not null").join(classes, key)
    reps = s.save(
        sigs.join(classes.withColumn("doc_id", F.col("rep")), ["doc_id", *key]).select("rep", "n_shingles", "sig", "buckets").dropDuplicates(["rep", "n_shingles"]), "reps"
    )
    # a doc_id with several texts may represent several classes: link those first
    own = members.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    twice = own.join(reps.select(F.col("rep").alias("a")).distinct(), "a", "left_semi")
    links = s.save(pair_links(spark, docs, reps, k, num, den, s).union(twice), "all-links")
    roots = components(links, s, "final")
    rooted = s.save(
        classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(*key, "rep", F.coalesce("root", "rep").alias("root")), "rooted"
    )
    return sigs.select("doc_id", *key).join(rooted, key, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
        (F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True))).alias("kept"),
    )


def without_copies(spark: SparkSession, docs: DataFrame, k: int = 5) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, and one of repeated rows; rows without a doc_id stay.

    Null and empty texts are copies of nothing and stay. Very long texts, ties and empty tables are
    as in ``near_duplicates``. All columns stay as they are, whatever their names.
    """
    kept = near_duplicates(spark, docs, k).where("kept and doc_id is not null").select("doc_id").distinct()
    (same,) = fresh(docs, "text_hash")
    known = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn(same, F.xxhash64("text"))
    return known.dropDuplicates(["doc_id", same]).drop(same).union(docs.where("doc_id is null"))


def pair_links(spark: SparkSession, docs: DataFrame, reps: DataFrame, k: int, num: int, den: int, s: Scratch) -> DataFrame:
    """Verified links between representatives: enough of them for the components to be whole."""
    linker = Linker(docs, reps, k, num, den, s)
    spread = reps.select("rep", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    bucket = s.save(spread.join(shared, "bucket"), "bucket")
    fame = s.save(bucket.groupBy("rep").agg(F.sum("size").alias("fame")), "fame")
    centre = s.save(
        bucket.where(f"size > {SMALL}").join(fame, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("fame", -F.col("rep"))).alias("centre")), "centre"
    )
    small = bucket.where(f"size <= {SMALL}").groupBy("bucket").agg(F.sort_array(F.collect_set("rep")).alias("m"))
    small = small.select(F.posexplode("m"), "m").select(F.col("col").alias("a"), F.explode(F.slice("m", F.col("pos") + 2, SMALL)).alias("b"))
    star = bucket.join(centre, "bucket").where("rep <> centre").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    tried = s.save(small.union(star).distinct(), "tried")
    links = linker.links(tried)
    roots = components(links, s, "round")
    joined = bucket.where(f"size > {SMALL}").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    # per bucket one row for each component in it, and only buckets with more than one
    parts = joined.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    split = s.save(
        parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("root", F.struct("n", -F.col("root"))).alias("main")).where("parts > 1").drop("parts"), "split"
    )
    if split.isEmpty():
        return links
    # who shares a bucket with a main component without being in it; each main component is one scope
    outside = s.save(joined.join(split, "bucket").where("root <> main").select(F.col("main").alias("scope"), "rep", "root").distinct(), "outside")
    scopes = outside.select("scope").distinct()
    inside = roots.toDF("rep", "root").join(scopes.withColumnRenamed("scope", "root"), "root").select(F.col("root").alias("scope"), "rep", "root")
    alone = scopes.join(roots.select(F.col("root").alias("scope")).distinct(), "scope", "left_anti").select("scope", F.col("scope").alias("rep"), F.col("scope").alias("root"))
    cast = outside.withColumn("main", F.lit(False)).union(inside.union(alone).withColumn("main", F.lit(True)))
    found = blockwise(s, docs, s.save(cast, "cast"), reps, k, num, den)
    return s.save(links.union(found), "links-whole")


#: Documents of a block, of which two at a time are compared in one call.
BLOCK = 128


def blockwise(s: Scratch, docs: DataFrame, cast: DataFrame, reps: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links between the components of each scope, from comparing blocks of its members in full.

    Members outside the main component meet all others of the scope that are near them in size:
    blocks hold sets of one class of sizes, classes grow by ``den / num``, and sets of classes that
    aren't neighbours can't be similar enough. A block pair gives one link at most for each
    outsider and component: more can't change what is connected.
    """
    ends = s.save(cast.select(F.col("rep").alias("doc_id")).distinct(), "cast-ids")
    sets = shingle_sets(docs, k, bloom_of(ends, "doc_id")).join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    level = F.floor(F.log(F.size("shingles").cast("double")) / float(np.log(den / num) if num < den else 1.0)).cast("int")
    full = s.save(
        cast.join(reps.select("rep", "sig"), "rep").join(sets.withColumnRenamed("doc_id", "rep"), "rep").where("size(shingles) > 0").withColumn("level", level).dropDuplicates(["scope", "rep"]), "cast-sets"
    )
    part = ["scope", "main", "level"]
    many = s.save(full.groupBy(*part).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "many")
    placed = full.join(many, part).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int"))
    # dealt by block: a partitioning by scope alone would put a large scope into one task
    placed = placed.repartition(*part, "block")
    blocks = s.save(placed.groupBy(*part, "block").agg(F.collect_list(F.struct("rep", "root", "sig", "shingles")).alias("members")), "blocks")
    # which blocks meet follows from their names; then each pair fetches its two blocks by name, so no task holds a scope
    left = blocks.where("not main").select("scope", F.col("level").alias("lx"), F.col("block").alias("ix"), F.explode(F.sequence(F.col("level") - 1, F.col("level") + 1)).alias("level"))
    right = blocks.select("scope", "main", "level", "block")
    pairs = left.join(right, ["scope", "level"]).where("main or struct(lx, ix) <= struct(level, block)")
    x = blocks.where("not main").select("scope", F.col("level").alias("lx"), F.col("block").alias("ix"), F.col("members").alias("x"))
    y = blocks.withColumnRenamed("members", "y")
    both = pairs.join(x, ["scope", "lx", "ix"]).join(y, [*part, "block"]).select("x", "y")

    def compare(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                x, y = (batch.column(c).slice(at, 1).flatten() for c in (0, 1))
                sx, sy = (np.frombuffer(b"".join(m.field("sig").to_pylist()), np.uint16).reshape(len(m), -1) for m in (x, y))
                (ix, rx), (iy, ry) = ((m.field("rep").to_numpy(), m.field("root").to_numpy()) for m in (x, y))
                own = [v.values.to_numpy() for v in x.field("shingles")]
                sizes = np.array([len(v) for v in y.field("shingles")])
                values, owner = y.field("shingles").flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
                found = []
                for a in range(len(ix)):
                    mine = np.sort(own[a])
                    near = (ry != rx[a]) & ((sy == sx[a]).mean(axis=1) >= SIGHT)
                    if not near.any() or not len(mine):
                        continue
                    use = near[owner]
                    spot = np.minimum(np.searchsorted(mine, values[use]), len(mine) - 1)
                    common = np.bincount(owner[use], mine[spot] == values[use], minlength=len(sizes))
                    good = np.flatnonzero(near & (common * den >= (len(mine) + sizes - common) * num))
                    _, first = np.unique(ry[good], return_index=True)
                    found += [(min(ix[a], iy[b]), max(ix[a], iy[b])) for b in good[first]]
                yield pa.RecordBatch.from_arrays([pa.array([int(f[i]) for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return both.mapInArrow(tidy(compare), "a long, b long").distinct()
