"""Queries over the driver's small tables, against SQL in DuckDB or brute force over the whole table."""

import glob
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from test_operators import components_of, plain_leaks, plain_shingles

from splicelake.llm import labelled, language, minhash, quality, registry, toxicity
from splicelake.llm.scratch import Scratch
from splicelake.llm.textarray import LOWER, mix64, running, span_hash

HERE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{HERE}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("select * from documents").df()


def rows(df):
    # whole numbers with nulls come as floats from one engine, as Int64 from the other
    df = df[sorted(df.columns)].astype({c: "float64" for c in df if str(df[c].dtype) == "Int64"})
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).astype(str).values.tolist())), list(df.columns)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, duck, name):
    got, want = registry.queries()[name](spark, HERE).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert rows(got) == rows(want) and len(got)


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_by_plain_compression(spark, documents):
    table = spark.read.parquet(f"{HERE}/documents.parquet")
    dictionaries = language.learn(table, ~language.held_out(F.col("doc_id")))
    assert set(dictionaries) == set(documents.lang.dropna()) and all(len(d) < 2 * language.DICT_BYTES for d in dictionaries.values())
    learned = documents[[crc(i) % 3 != 1 for i in documents.doc_id]]
    for lang, d in dictionaries.items():  # whole texts of learned rows only
        texts = {language.plain(t.encode()) for t in learned[learned.lang == lang].text.dropna()}
        left = d.rstrip(b" ") + b" "
        assert sum(len(t) for t in texts if t in left) >= 0.9 * min(len(left), language.DICT_BYTES)
    how = zstandard.ZstdCompressionParameters(**language.CODER, window_log=max(18, (max(map(len, dictionaries.values())) + language.PIECE).bit_length()))
    got = {r["doc_id"]: r for r in language.languages(table).collect()}
    assert len(got) == len(documents)
    right = []
    for i, text, lang in zip(documents.doc_id, documents.text, documents.lang):
        if text is None or not any(c.isalpha() for c in text):
            assert got[i]["lang_pred"] == "und"
            continue
        words = " ".join(re.findall("[a-z\u0080-\U0010ffff]+", text.lower()))
        sizes = {}
        for la in sorted(dictionaries):
            coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionaries[la], dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how)
            whole, known = f" {words} ".encode(), set(dictionaries[la].decode("utf-8", "replace").split())
            sizes[la] = sum(len(coder.compress(whole[k : k + language.PIECE])) for k in range(0, len(whole), language.PIECE)) + sum(w not in known for w in words.split())
        assert got[i]["lang_pred"] == min(sizes, key=sizes.get)
        right += [got[i]["lang_pred"] == lang] if got[i]["held_out"] else []
    assert np.mean(right) > 0.95


def exact_components(texts, k):
    """Components of all pairs of at least 80 % of the union in common, found by what shares a shingle."""
    sets = {i: frozenset(plain_shingles(t, k)) for i, t in texts}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    edges = []
    for i, s in sets.items():
        n = defaultdict(int)
        for x in s:
            for j in where[x]:
                if j < i:
                    n[j] += 1
        edges += [(j, i) for j, c in n.items() if 100 * c >= 80 * (len(s) + len(sets[j]) - c)]
    return components_of(edges, sets), sets


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_of_a_whole_table(spark, k):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, sets = exact_components([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()], k)
    got = minhash.near_duplicates(spark, table, k=k).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(set(want.values())) < len(want)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in got)


def tokens(text):
    return " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def test_leaks_of_a_whole_table(spark, duck, documents):
    items = [(i, tokens(t)) for i, t in duck.execute("select item_id, text from benchmark").fetchall()]
    want = plain_leaks([(i, tokens(t)) for i, t in zip(documents.doc_id, documents.text) if t], [x for x in items if x[1]])
    got = {(r["doc_id"], r["item_id"]) for r in registry.op6_decontamination(spark, HERE).collect()}
    assert got == want and want


def test_quality_by_one_text_at_a_time(spark, duck, documents):
    """The sample drawn by hand, the statistics of each text alone, and the fit on them."""
    labels = dict(duck.execute("select doc_id, quality from labels").fetchall())
    learned = [(i, t or "") for i, t in zip(documents.doc_id, documents.text) if crc(i) % 5 != 0]

    def numbers(text):
        raw = text.encode()
        return tuple(quality.statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])

    good, any_ = sorted(numbers(t) for i, t in learned if labels.get(i) == 1), sorted(numbers(t) for _, t in learned)
    model = quality.fit(np.array(good), np.array(any_))
    got = {r["doc_id"]: r for r in registry.op7_quality(spark, HERE).collect()}
    assert len(got) == len(documents)
    for i, t in zip(documents.doc_id, documents.text):
        score = float(model.score(np.array([numbers(t or "")]))[0])
        assert abs(got[i]["score"] - score) < 1e-9 and got[i]["predicted"] == (score >= 0.3) and got[i]["held_out"] == (crc(i) % 5 == 0)


def plain_features(text):
    """Letter runs and their prefixes, one at a time."""
    out, raw = set(), re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    found = re.findall(rb"[a-z\x80-\xff]+", raw)
    for w in found:
        sums = running(LOWER[np.frombuffer(w, np.uint8)])
        at = lambda end: span_hash(sums, np.array([0]), np.array([end]))
        out.add(int(at(len(w))[0]) & (1 << toxicity.BITS) - 1)
        out |= {int(mix64(at(k) + np.uint64(k))[0]) & (1 << toxicity.BITS) - 1 for k in toxicity.PREFIXES if len(w) > k}
    return out, len(found)


def test_toxicity_by_one_text_at_a_time(spark, duck, documents):
    table, labels = (spark.read.parquet(f"{HERE}/{t}.parquet") for t in ("documents", "labels"))
    sample = labelled.sample(table, labels, "toxic", ~toxicity.held_out(F.col("doc_id")), Scratch(spark, "t"))
    want = {i for i, y in duck.execute("select doc_id, toxic from labels where toxic is not null").fetchall() if crc(i) % 4 != 2}
    assert {r["doc_id"] for r in sample.collect()} == want & set(documents.doc_id)
    model = toxicity.fit(sample)
    again = toxicity.fit(sample.repartition(7, "y").sortWithinPartitions("y"))  # dealt by label: the same model
    assert np.array_equal(model.weights, again.weights) and model[1:] == again[1:] and np.count_nonzero(model.weights)
    got = {r["doc_id"]: r for r in registry.op9_toxicity(spark, HERE).collect()}
    for i, t in zip(documents.doc_id, documents.text):
        features, n = plain_features(t)
        z = sum(float(model.weights[f]) for f in features) + model.bias + model.length * np.log1p(n) / 10
        assert abs(got[i]["score"] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-5


def test_media_of_a_whole_table(spark, documents):
    import hashlib

    got = {r["doc_id"]: r for r in registry.op5_media(spark, HERE).collect()}
    assert len(got) == len(documents)
    for i, t in zip(documents.doc_id, documents.text):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        assert r["intact"] and (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    by = defaultdict(set)
    for i, t in zip(documents.doc_id, documents.text):
        by[t or ""].add((got[i]["media_bytes"], got[i]["media_sha256"], got[i]["feature"]))
    assert all(len(x) == 1 for x in by.values())
