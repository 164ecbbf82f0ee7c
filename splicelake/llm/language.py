"""Language ID by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textarray import slices, tidy

#: Bounds of what is learned: languages, the commonest first, and bytes of plain text of each. Whole texts
#: are drawn until a dictionary has them, those that are longer than a dictionary only where others don't fill it.
LANGUAGES, DICT_BYTES = 128, 1 << 17
PIECE = 2048
#: Matches of four bytes count, which words of a few syllables need; windows hold dictionary and piece.
CODER = dict(write_content_size=0, write_checksum=0, write_dict_id=0, hash_log=17, chain_log=17, strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=3, target_length=8)
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Relative difference of the two smallest sizes below which the choice is rejected.
MARGIN = 0.005


def learn(docs: DataFrame, allowed: Column) -> dict[str, bytes]:
    """Raw-content dictionaries of each language, from a bounded sample of whole documents with a ``lang``.

    The share of rows drawn of a language follows from how many bytes all of it has, so the
    driver gets a few times ``DICT_BYTES`` of each.
    """
    own = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(allowed)
    own = own.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"), F.octet_length("text").alias("bytes")).where("bytes > 0")
    fits = F.col("bytes") <= DICT_BYTES
    counts = own.groupBy("lang").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(fits, F.col("bytes"))), F.lit(0)).alias("fitting"))
    found = counts.orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()
    if not found:
        return {}
    rate = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], 4.0 * DICT_BYTES / max(r["fitting"], 1))])
    drawn = own.where(fits & (F.pmod("h", F.lit(1 << 30)) / float(1 << 30) < F.element_at(rate, F.col("lang")))).select("lang", "h", "text")
    long = [r["lang"] for r in found if r["fitting"] < DICT_BYTES]
    if long:
        drawn = drawn.union(own.where(~fits & F.col("lang").isin(long)).groupBy("lang").agg(F.min_by(F.struct(F.lit(1 << 62).alias("h"), "text"), "h").alias("x")).select("lang", "x.*"))
    rows = drawn.dropDuplicates(["lang", "h"]).toPandas()
    out = {}
    for lang, part in rows.sort_values(["h", "text"]).groupby("lang"):
        texts, size = [], 0
        for t in part.text:
            if size >= DICT_BYTES:
                break
            texts.append(plain(t.encode()))
            size += len(texts[-1])
        out[lang] = b"".join(texts).ljust(64)
    return out


def plain(text: bytes) -> bytes:
    """Lower-case words with one space around each; digits, signs and layout tell no language."""
    return b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()) + b" "


class Sizer:
    """Code lengths of a text under each language's dictionary: its compressed size, and a byte for each word that the dictionary lacks."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.tools = []
        room = max((len(d) for d in dictionaries.values()), default=0) + PIECE
        how = zstandard.ZstdCompressionParameters(**CODER, window_log=min(27, max(18, room.bit_length())))
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.tools.append((zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress, frozenset(dictionaries[lang].split())))

    def sizes(self, text: bytes) -> list[int]:
        """Bytes for each language; long texts go piece by piece, all of them."""
        pieces, found = [text[at : at + PIECE] for at in range(0, len(text), PIECE)], text.split()
        return [sum(len(compress(p)) for p in pieces) + len(found) - sum(map(known.__contains__, found)) for compress, known in self.tools]

    def choose(self, text: bytes) -> tuple[str, float, float]:
        """Language, score from 0 to 1, and relative margin."""
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        score = 1 / sum(2.0 ** -min(60, s - best) for s in sizes)
        margin = (sizes[order[1]] - best) / sizes[order[1]] if len(order) > 1 else 1.0
        return self.langs[order[0]], score, margin


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every document.

    ``lang_pred`` is the language of the smallest size, ``rejected`` says that the
    margin to the next is too narrow to rely on it. Null texts and those without a
    letter are ``und`` with score 0, as is everything if no language was learned.
    Ties go to the first language by name. Rows may repeat; other columns don't matter.
    """
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def scan(batches):
        sizer = Sizer(held.value)
        for batch in batches:
            for part in slices(batch.column(1)):
                n = len(part.offsets) - 1
                out = []
                for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True):
                    text = part.data[a:b].tobytes()
                    out.append(sizer.choose(plain(text)) if sizer.langs and _has_letter(text) else ("und", 0.0, 0.0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] < MARGIN for o in out])],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    source = docs.select("doc_id", "text")
    return source.mapInArrow(tidy(scan), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: learned from documents that aren't held out, for all of them.

    Learned from ``lang`` and ``text`` of ``LANGUAGES`` languages and ``DICT_BYTES`` of each at most;
    rows without a lang, text or doc_id teach nothing. Null texts and those without a letter are
    ``und``, as is every text if nothing is learned. Texts of one word and of any length are sized
    whole by one rule; ties go to the first language by name. A row in, a row out: ids may
    repeat or be null (``held_out`` is null then). An empty table gives no rows; other columns
    don't matter, whatever their names.
    """
    found = identify(docs, learn(docs, ~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
