"""Each operator against a plain version or an exact round trip, and on odd tables."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from splicelake.llm import decontamination, htmltext, language, linedup, media, minhash, mixing, quality, toxicity, warc
from splicelake.llm.components import components
from splicelake.llm.scratch import Scratch
from splicelake.llm.textarray import shingles, slices, words

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", src, len(t or "")) for i, t, src in rows], DOC).repartition(3)
    # names that operators use themselves
    return df.withColumns({"size": F.lit(1), "score": F.lit(2), "x": F.lit("y"), "sig": F.lit(0), "_text": F.lit(0)}) if extra else df


def prose(rng, n, words_="the of and lorem ipsum dolor sit amet vita brevis ars longa ten rivers stone".split()):
    return " ".join(rng.choice(words_) + rng.choice(["", "a", "el", "on", "ix"]) * rng.randrange(3) for _ in range(n))


ODD = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (4, "one", "b"), (None, "no id here at all", "b"), (5, "word " * 60_000, None), (6, "é" * 50, "c")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD, extra=True).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(40)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_shingles(text, k):
    w = plain_words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def test_words_and_shingles():
    rng = random.Random(3)
    texts = [None, "", "a", "A b\tc\nD", "x\x0by é è", "a b a b a b", prose(rng, 500), " lead", "trail "] + [prose(rng, rng.randrange(9)) for _ in range(50)]
    for target in (1, 10, 1 << 19):
        got = []
        for part in slices(pa.array(texts, pa.string()), target):
            w = words(part.data, part.offsets)
            for k in (2, 5):
                row, _ = shingles(w, len(part.offsets) - 1, k)
                got += [(part.first + r, k, n) for r, n in enumerate(np.bincount(row, minlength=len(part.offsets) - 1).tolist())]
        assert sorted(got) == sorted((i, k, len(plain_shingles(t, k))) for i, t in enumerate(texts) for k in (2, 5))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        a = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        b = a.copy()
        swap = int(len(a) * (1 - share) / (1 + share))
        b[:swap] = rng.integers(0, 1 << 62, swap)
        s = minhash.superminhash(np.repeat([0, 1], len(a)), np.concatenate((a, b)), 3)
        assert abs((s[0] == s[1]).mean() - share) < 0.15
        assert (s[2] == s[2][0]).all()  # no elements


def components_of(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    chain = [(k, k + 1) for k in range(0, 40)]
    rng.shuffle(chain)
    edges = chain + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()))
    edges = [(a, b) for a, b in edges if a != b]
    want = components_of(edges, {n for e in edges for n in e})
    assert got == want


def copies(seed):
    rng, out = random.Random(seed), []
    base = prose(rng, 120).split()
    for k in range(90):  # one large group, some of it near the limit
        w = list(base)
        for _ in range(rng.choice([0, 0, 3, 8, 12, 16])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
        out.append(" ".join(w))
    out += [prose(rng, rng.randrange(3, 60)) for _ in range(60)]
    out += out[95:100] + [out[120].upper(), out[121] + " tail"]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("small", [2, 16])
def test_near_duplicates(spark, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK", 20)
    rows = copies(small)
    sets = {i: plain_shingles(t, 2) for i, t in rows}
    edges = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components_of(edges, sets)
    got = minhash.near_duplicates(spark, docs(spark, [(i, t, "s") for i, t in rows]), k=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) and r["n_shingles"] == len(sets[r["doc_id"]]) for r in got)


def test_near_duplicates_of_odd_rows(spark, odd):
    got = minhash.near_duplicates(spark, odd, k=2).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[1]["kept"] and by[2]["component_id"] == 2
    assert by[4]["n_shingles"] == 1 and by[5]["n_shingles"] == 1 and by[None]["component_id"] is None
    assert minhash.without_copies(spark, odd).count() == len(ODD) - 1  # one of the repeated rows goes
    assert minhash.near_duplicates(spark, odd.where("false")).count() == 0


def test_line_dedup(spark):
    rng = random.Random(5)
    passage = prose(rng, 60)
    rows = [(k, f"{prose(rng, 12)}\n{passage}\n{prose(rng, 9)}\ntoo short", "s") for k in range(6)]
    rows += [(10 + k, f"{prose(rng, 12)}\nSent on {k} May to reader number {k * 7} of our list\n{prose(rng, 9)}", "s") for k in range(4)]
    half = [prose(rng, 20).split() for _ in range(2)]
    rows += [(20 + k, "\n".join((prose(rng, 9), " ".join(half[0] + prose(rng, 17).split()), prose(rng, 8))), "s") for k in range(5)]
    copy = f"{prose(rng, 30)}\n{prose(rng, 30)}"
    rows += [(30 + k, copy, "s") for k in range(5)]  # copies of a document don't make its lines boilerplate
    got = {r["doc_id"]: r for r in linedup.line_dedup(spark, docs(spark, rows)).collect()}
    text = {i: t for i, t, _ in rows}
    for k in range(6):
        lines = text[k].split("\n")
        assert got[k]["text"] == "\n".join(lines[:1] + lines[2:]) and (got[k]["n_lines"], got[k]["n_dropped"]) == (4, 1)
    assert all("reader number" not in got[10 + k]["text"] and got[10 + k]["n_dropped"] == 1 for k in range(4))
    assert all(got[20 + k]["n_dropped"] == 1 for k in range(5))
    assert all(got[30 + k]["text"] == copy for k in range(5))


def test_line_dedup_whatever_the_white_space(spark):
    rng = random.Random(31)
    passage = prose(rng, 20)
    forms = [passage, passage + "\r", passage.replace(" ", "\t"), "  " + passage.replace(" ", "  ", 3), passage + " \t"]
    rows = [(k, f"{prose(rng, 12)}\n{line}\n{prose(rng, 9)}", "s") for k, line in enumerate(forms)]
    got = linedup.line_dedup(spark, docs(spark, rows)).collect()
    assert len(got) == 5 and all(r["n_dropped"] == 1 and len(r["text"].split("\n")) == 2 for r in got)


def test_line_dedup_of_blocks_blank_lines_and_copies(spark):
    rng = random.Random(32)
    block = [prose(rng, 15) for _ in range(3)]
    rows = [(k, "\n\n".join([prose(rng, 12), *block, prose(rng, 9)]), "s") for k in range(6)]
    rows += [(10 + k, "\n".join([prose(rng, 12), prose(rng, 9), *block]), "s") for k in range(4)]
    base, line = [prose(rng, 14) for _ in range(30)], prose(rng, 22)
    near = []
    for k in range(40):  # near copies that hold a template and are edited each in another place
        lines = base[:15] + [line] + base[15:]
        lines[k % 15] = prose(rng, 14)
        near.append((100 + k, "\n".join(lines), "s"))
    rows += near + [(200 + k, f"{prose(rng, 12)}\n{line}\n{prose(rng, 9)}", "s") for k in range(5)]
    got = {r["doc_id"]: r for r in linedup.line_dedup(spark, docs(spark, rows)).collect()}
    assert all(got[i]["n_dropped"] == 3 and not any(b in got[i]["text"] for b in block) for i in [*range(6), *range(10, 14)])
    assert all(got[i]["n_dropped"] == 1 for i in range(200, 205))
    assert all(got[i]["text"] == "\n".join(x for x in t.split("\n") if x != line) for i, t, _ in near)


def test_line_dedup_of_short_unspaced_and_long_lines(spark):
    rng = random.Random(33)
    long, unspaced = prose(rng, 60), "條款" * 30
    rows = [(k, f"{prose(rng, 12)}\nAll rights reserved.\n{prose(rng, 9)}\n{k % 9}", "s") for k in range(12)]
    rows += [(20 + k, f"{prose(rng, 12)}\n{long}\n{prose(rng, 9)}", "s") for k in range(2)]
    rows += [(30 + k, f"{prose(rng, 12)}\n{unspaced}\n{prose(rng, 9)}\nread on", "s") for k in range(3)]
    got = linedup.line_dedup(spark, docs(spark, rows)).collect()
    assert len(got) == 17 and all(r["n_dropped"] == 1 for r in got)
    assert not any(x in r["text"] for r in got for x in ("reserved", long, unspaced))


def test_line_dedup_of_odd_rows(spark, odd):
    got = linedup.line_dedup(spark, odd).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted((i or 0, t or "") for i, t, _ in ODD)
    assert {r["n_lines"] for r in got if r["doc_id"] == 1} == {0} and {"x", "sig", "score"} <= set(got[0].asDict())
    assert linedup.line_dedup(spark, odd.where("false")).count() == 0


def test_short_boilerplate_of_all_documents_goes(spark):
    rng = random.Random(41)
    rows = [(k, f"{prose(rng, 14)}\nShare this article\n{prose(rng, 11)}", "s") for k in range(200)]
    got = linedup.line_dedup(spark, docs(spark, rows)).collect()
    assert all(r["n_dropped"] == 1 and "Share" not in r["text"] for r in got) and len(got) == 200


def test_line_dedup_of_copies_beside_unrelated_texts(spark):
    rng = random.Random(42)
    passage = prose(rng, 60)
    pair = "\n".join(prose(rng, 60) for _ in range(12))  # long lines, which go from two unrelated texts on
    rows = [(1, pair, "s"), (2, pair.replace("the", "then", 1), "s"), (3, pair, "s")]
    family = [prose(rng, 20) for _ in range(20)]
    rows += [(10 + k, "\n".join([*family[:9], passage, *family[9:], f"edited {k}"]), "s") for k in range(4)] + [(20, f"{prose(rng, 30)}\n{passage}", "s")]
    got = {r["doc_id"]: r for r in linedup.line_dedup(spark, docs(spark, rows)).collect()}
    assert all(got[i]["n_dropped"] == 0 for i in (1, 2, 3))
    assert all(passage not in got[i]["text"] and got[i]["n_dropped"] == 1 for i in (10, 11, 12, 13, 20))


def test_line_dedup_of_a_text_of_many_lines(spark):
    rng = random.Random(43)
    lines = [prose(rng, 12) for _ in range(20_000)]
    rows = [(k, f"{prose(rng, 12)}\n" + "\n".join(lines) + f"\n{prose(rng, 9)}" * 3000, "s") for k in range(3)]
    got = linedup.line_dedup(spark, docs(spark, rows)).collect()
    assert all(r["n_lines"] == 23_001 for r in got)


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.randrange(1, 30)), rng.choice(["a"] * 30 + ["b"] * 8 + ["c", "d", None])) for k in range(3000)]
    got = mixing.mix(spark, docs(spark, rows)).collect()
    size, taken, target = {}, {}, {}
    for r in got:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["size"] == len(plain_words(r["text"])) and r["taken"] in [k * r["size"] for k in range(4)]
    order = ["a", "b", "c", "d", None]
    weight = dict(zip(order, (5, 2, 1, 5, 2)))
    full = set()
    while True:
        left = sum(size.values()) - sum(3 * size[x] for x in full)
        level = left / sum(weight[x] for x in order if x not in full)
        more = {x for x in order if x not in full and weight[x] * level > 3 * size[x]}
        if not more:
            break
        full |= more
    want = {x: 3 * size[x] if x in full else weight[x] * level for x in order}
    assert all(abs(target[x] - want[x]) < 1e-6 * want[x] for x in order) and full
    assert all(abs(taken[x] - target[x]) <= 15 for x in order)
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in mixing.mix(spark, docs(spark, rows)).collect()}


def test_mixing_of_odd_rows(spark, odd):
    got = mixing.mix(spark, odd).collect()
    assert len(got) == len(ODD) and {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix(spark, odd.where("false")).count() == 0
    assert {r["taken"] for r in mixing.mix(spark, odd.where("doc_id < 4")).collect()} == {0}


def test_leaks(spark):
    rng = random.Random(4)
    vocabulary = [f"w{rng.randrange(10**6):06d}" for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(40)) for k in range(30)] + [(90, "Why? answer: because of rain and nothing else " + text(10)), (91, None), (92, ""), (93, "a b c")]
    rows, want = [], set()
    for k in range(200):
        body = text(rng.choice([5, 60, 400])).split()
        if k % 4 == 0:
            item = items[k // 4 % 30]
            said = item[1].split()
            if k % 8 == 0:  # reworded: a fifth of the words are others
                for at in rng.sample(range(30), 7):
                    said[at] = "other"
            at = rng.randrange(len(body))
            body[at:at] = said
            want.add((k, item[0]))
        rows.append((k, " ".join(body), "s"))
    rows += [(900, items[3][1].upper() + "!", "s"), (901, None, "s"), (None, items[4][1], "s")]
    want |= {(900, 3), (None, 4)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(spark, docs(spark, rows), bench).collect()}
    assert got == want
    kept = {r["doc_id"] for r in decontamination.without_leaks(spark, docs(spark, rows), bench).collect()}
    assert kept == {i for i, _, _ in rows} - {d for d, _ in want if d is not None}


def zipf_words(rng, size=20_000):
    weights = np.cumsum(1 / np.arange(1, size + 1))
    return lambda n: [f"v{k}" for k in np.searchsorted(weights, rng.random(n) * weights[-1])]


def plain_leaks(rows, items):
    """All pairs by the longest common subsequence of every item and every stretch, without any test before it."""
    out = set()
    for doc, text in rows:
        text = text.split()
        for item, words in items:
            words = words.split()
            size = min(s for s in decontamination.SCALES if s >= len(words))
            for at in range(0, max(1, len(text) - size // 2), size // 2):
                part = text[max(0, at - len(words)) : at + size + len(words)]
                share = decontamination.lcs(words, part) / len(words)
                said = decontamination.lcs(words[-8:], part) == len(words[-8:])
                if len(words) < 8:
                    share, said = float(any(part[j : j + len(words)] == words for j in range(len(part)))), False
                if share >= 0.7 or share >= 0.5 and said:
                    out.add((doc, item))
    return out


def test_leaks_of_more_items_than_the_rank(spark):
    rng = np.random.default_rng(1)
    words = zipf_words(rng)
    items = [(k, " ".join(words(40))) for k in range(1000)]
    rows = []
    for k in range(60):
        said = items[k * 16][1].split()
        for at in rng.choice(32, 8, replace=False) if k % 2 else []:
            said[at] = "other"
        rows.append((k, " ".join(words(30) + said + words(60)) if k % 3 else " ".join(words(130))))
    want = plain_leaks(rows, items)
    assert len(want) >= 40
    got = decontamination.leaks(spark, docs(spark, [(i, t, "s") for i, t in rows]), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


@pytest.mark.parametrize("n,copies", [(20, 3), (200, 100)])
def test_leaks_that_many_documents_hold(spark, n, copies):
    rng = random.Random(21)
    text = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    common = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one".split()
    items = [(1, text(40)), (2, " ".join(rng.sample(common, 20)))]
    rows = [(k, f"{text(20)} {items[0][1]} {text(9)}" if k < copies else text(60), "s") for k in range(n)]
    rows += [(1000 + k, " ".join(rng.choice(common + [f"x{j}" for j in range(150)]) for _ in range(90)), "s") for k in range(n)] + [(2000, f"{text(5)} {items[1][1]} {text(5)}", "s")]
    got = decontamination.leaks(spark, docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, 1) for k in range(copies)} | {(2000, 2)} == plain_leaks([r[:2] for r in rows], items)
    assert all(r["cosine"] > 0.3 for r in got)


def test_leaks_of_short_items_in_long_texts(spark):
    rng = np.random.default_rng(3)
    words = zipf_words(rng)
    sizes = (3, 5, 8, 12, 16, 24)
    items = [(k, " ".join(words(sizes[k % 6]))) for k in range(60)]
    rows = [(k, " ".join(words(100) + text.split() + words(100))) for k, text in items]
    want = plain_leaks(rows, items)
    assert {(k, k) for k in range(60)} <= want
    got = decontamination.leaks(spark, docs(spark, [(i, t, "s") for i, t in rows]), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_leaks_of_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "no id here at all"), (2, None)], "item_id long, text string")
    assert decontamination.leaks(spark, odd, bench).count() == 1
    assert decontamination.leaks(spark, odd, bench.where("false")).count() == 0
    assert decontamination.leaks(spark, odd.where("false"), bench).count() == 0


def test_lcs():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontamination.lcs(a, b) == t[-1][-1]


def test_randomised_svd(spark):
    rng = np.random.default_rng(0)
    rows = [(k, 0, [int(x) << 20 for x in rng.integers(0, 60, 12)], []) for k in range(40)]
    df = spark.createDataFrame(rows, "item_id long, part long, words array<long>, answer array<long>")
    idf = np.ones(decontamination.DIMENSIONS, np.float32)
    a = np.zeros((40, 60))
    for k, _, w, _ in rows:
        a[k, np.unique([x >> 20 for x in w])] = 1
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    v = decontamination.randomised_svd(df, idf, np.arange(60), 8)[:60]
    got = np.linalg.norm(a @ v, axis=0)
    assert np.allclose(got, np.linalg.svd(a)[1][:8], rtol=0.05)


def test_media(spark, odd):
    rng = random.Random(7)
    long = prose(rng, 20_000)
    rows = ODD + [(10, long, "s"), (11, "other start " + long, "s"), (12, long, "s"), (13, "x" * 64, "s")]
    got = {r["doc_id"]: r for r in media.media(spark, docs(spark, rows)).collect()}
    for i, text, _ in rows:
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r["intact"]
    assert (got[10]["media_sha256"], got[10]["feature"]) == (got[12]["media_sha256"], got[12]["feature"])
    s = Scratch(spark, "m")
    _, stored = media.store(spark, docs(spark, [(1, long, "s"), (2, "other start " + long, "s")]), s)
    assert stored.agg(F.sum(F.octet_length("bytes"))).first()[0] > 0.8 * len(long)  # a shifted copy shares its chunks
    assert media.media(spark, odd.where("false")).count() == 0


def test_damaged_media_is_noticed(spark):
    s = Scratch(spark, "m")
    containers, stored = media.store(spark, docs(spark, [(1, "abc " * 900, "s"), (2, "abc " * 900, "s"), (3, "fine", "s")]), s)
    bad = stored.withColumn("bytes", F.concat(F.lit(b"\x00"), F.expr("substring(bytes, 2)")))
    assert {r["doc_id"]: r["intact"] for r in media.restore(containers, bad, s).collect()} == {1: False, 2: False, 3: True}


def page_rows():
    return [
        (1, "u", "a"), (2, "u", "a"), (3, None, None), (4, "x", ""), (5, "n", "pre WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\npost é"),
        (6, "n", "WARC/1.1\r\nWARC/1.1\r\n"), (7, "z\r\nq", "é\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (8, "n", "x" * 5000), (9, "n", "pre WARC/1.1\r\nContent-Length: 999999\r\n\r\nhello"), (9, "n", "pre WARC/1.1\r\nContent-Length: 999999\r\n\r\nhello"), (None, "n", "a"),
    ]


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_warc_round_trip(spark, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").withColumn("sha", F.lit(1)).coalesce(1)
        got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark, pages).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first, want = {}, []
    for i, _, h in sorted(page_rows(), key=lambda r: r[0] or 1e9):
        raw = (h or "").encode()
        first.setdefault(raw, i)
        again = i is not None and first[raw] != i
        want.append((i or 0, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[raw] if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(spark, pages.where("false")).count() == 0


def test_record_ids_are_unique(spark):
    pages = spark.createDataFrame(page_rows() * 2, "page_id long, url string, html string")
    s = Scratch(spark, "w")
    warc.write(spark, pages, s.path("archive"), s)
    ids = [r["record_id"] for r in warc.read(spark, s.path("archive"), s).collect()]
    assert len(ids) == 2 * len(page_rows()) == len(set(ids))


def test_warc_whose_splits_change_between_scans(spark, monkeypatch):
    sizes = iter(["700", "128m", "900", "1500", "300"] * 20)

    class Changing(Scratch):
        def save(self, df, name):
            out = super().save(df, name)
            self.spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
            return out

    monkeypatch.setattr(warc, "Scratch", Changing)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [(k, "u", f"<p>{k}</p>" + ("x" * 40 + "\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" if k % 3 == 0 else "y" * (k * 7)) * 3) for k in range(60)]
    try:
        found = warc.round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        got = {r["page_id"]: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 60
    for k, _, html in rows:
        assert got[k]["intact"] and got[k]["payload_digest"] == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode() and got[k]["payload_bytes"] == len(html.encode())


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<p>One<br>two &amp; three</p>", "One two & three"),
        ("<nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>T</h1><p><b>Bold</b>ly <i>go</i><p>Next", "T\n\nBoldly go\n\nNext"),
        ("<article><p>A</p><div class='comments'><p>Nice!</p></div><aside>x</aside><form>f</form><p>B</p></article><footer>f</footer>", "A\n\nB"),
        ("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<main><p>kept</p><p>cut <a href='x", "kept\n\ncut"),
        ("<div class=\"ad-banner\">Buy</div><div><p>" + "It is the story of the cat and the dog. " * 6 + "</p><p>Short.</p></div>", ("It is the story of the cat and the dog. " * 6).strip() + "\n\nShort."),
        ("<p>" + "It is the story of the cat and the dog. " * 6 + "</p><p>" + "<a href=x>link text that is long enough to be read</a> " * 4 + "</p>", ("It is the story of the cat and the dog. " * 6).strip()),
        ("<article><table><tr><td>x<td>y</table>a  b</article>", "x\n\ny\n\na b"),
    ],
)
def test_html(page, text):
    assert htmltext.main_text(page) == text


PROSE = "It is the story of the cat and the dog that was in the house. "


def test_html_rules_decide_pages_without_an_article():
    links = "".join(f"<li><a href='/{k}'>Section number {k} of the site</a></li>" for k in range(9))
    body = [PROSE * 6, "Short one.", PROSE * 5, "xq zz 17; " * 40, PROSE * 4]
    page = f"<body><div><ul>{links}</ul></div><div>" + "".join(f"<p>{t}</p>" for t in body) + f"</div><div><ul>{links}</ul><p>Contact</p></div></body>"
    found = htmltext.blocks(page)
    assert {b.place for b in found} == {""}
    decided = [htmltext.first_pass(b) for b in found]
    assert sum(x is not None for x in decided) >= 0.8 * len(decided) and decided.count(False) == 18
    # ambiguous blocks take the label of their nearest decided neighbours
    assert htmltext.main_text(page) == "\n\n".join(" ".join(t.split()) for t in body)


def test_html_rules_decide_inside_an_article():
    page = f"<article><p>{PROSE * 5}</p><ul><li><a href=x>{'Read this next ' * 6}</a></li></ul><p>End.</p></article>"
    assert htmltext.main_text(page) == (PROSE * 5).strip() + "\n\nEnd."


def test_html_in_time_in_proportion():
    import time

    def took(n):
        began = time.perf_counter()
        htmltext.main_text("<b>" * n + "<p></p>" * n + "<div>" * n + "<li>x" * n)
        return time.perf_counter() - began

    took(2000)
    assert took(32_000) < 40 * max(took(2000), 0.005)


def test_html_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>é</p>"), (2, "u", "<" * 100_000)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {(r["page_id"], r["text"][:2], r["n_chars"] < 2) for r in htmltext.extract(df).collect()}
    assert (1, "", True) in got and (None, "é", True) in got
    assert htmltext.extract(df.where("false")).count() == 0


def test_language(spark):
    rng = random.Random(8)
    vocabulary = {"aa": "lomi tera bosh kinu vane".split(), "bb": "que ziu farr noto plex".split()}
    rows = [(k, prose(rng, rng.choice([4, 40]), vocabulary[("aa", "bb")[k % 2]]), ("aa", "bb")[k % 2]) for k in range(300)]
    df = spark.createDataFrame([(i, t, la) for i, t, la in rows] + [(400, None, "aa"), (401, "123 !?", "bb"), (402, "", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.languages(df).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in got if got[i]["held_out"] and i < 400} == set(held)
    assert np.mean([got[i]["lang_pred"] == rows[i][2] for i in held]) > 0.98
    assert {got[i]["lang_pred"] for i in (400, 401, 402)} == {"und"} and all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_odd_rows(spark, odd):
    assert language.languages(odd).count() == len(ODD)
    assert {r["lang_pred"] for r in language.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.languages(odd.where("false")).count() == 0


def test_toxicity(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for k in range(900):
        t = prose(rng, 30).split()
        toxic = k % 5 == 0
        if toxic:
            t[rng.randrange(30)] = rng.choice(["grumbat", "grumbol,", "Vilefop!"])
        if k % 7 == 0 or toxic and k % 2:  # groups are named more often in toxic texts
            t[rng.randrange(30)] = rng.choice(["muslim", "gay", "women"])
        rows.append((k, " ".join(t), "s"))
        marks.append((k, 1, int(toxic)))
    lab = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    plain = [(5000 + k, f"{prose(rng, 12)} {g} {prose(rng, 12)}", "s") for k, g in enumerate(["muslim", "gay", "women", "jewish", "black"])]
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs(spark, rows + plain), lab).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(got[k]["held_out"] for k in held)
    assert np.mean([got[k]["predicted"] == (k % 5 == 0) for k in held]) > 0.97
    assert not any(got[i]["predicted"] for i, _, _ in plain)
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs(spark, rows + plain), lab).collect()}
    assert kept == {i for i in got if not got[i]["predicted"]}


def test_counts_of_features_in_tasks_without_toxic_documents():
    def batch(texts, y):
        return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(y)], names=["text", "y"])

    def summed(tasks):
        out = {}
        for task in tasks:
            for got in toxicity._counts(iter(task)):
                for f, a, b in zip(*(c.to_pylist() for c in got.columns), strict=True):
                    n = out.setdefault(f, [0, 0])
                    n[0], n[1] = n[0] + a, n[1] + b
        return out

    parts = [batch(["grumbat lies", "fine words"], [1, 0]), batch(["grumbat sleeps", "more words"], [0, 0])]
    assert summed([[parts[0]], [parts[1]]]) == summed([parts])


def test_identity_terms_are_swapped():
    assert toxicity.swapped("nothing here") == []
    other, neutral = toxicity.swapped("The gay man and Women")
    assert "gay" not in other.lower() and neutral == "The person man and person"


@pytest.mark.parametrize("f", [toxicity.toxicity, quality.quality])
def test_classifiers_of_odd_rows(spark, odd, labels, f):
    for lab in (labels, labels.where("false"), labels.where("toxic = 1 and quality = 1")):
        got = f(odd, lab).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert f(odd.where("false"), labels).count() == 0


def test_quality(spark):
    rng = random.Random(11)
    rows, marks = [], []
    for k in range(800):
        t = prose(rng, rng.randrange(20, 80))
        bad = k % 4 == 0
        if bad:
            t = rng.choice([lambda x: x.upper().replace(" ", "!! "), lambda x: x.replace(" ", " | "), lambda x: x.replace(" ", "### ")])(t)
        rows.append((k, t, "s"))
        if k % 2 == 0 or not bad:
            marks.append((k, int(not bad), 0))
    got = {r["doc_id"]: r for r in quality.quality(docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    held = [k for k in range(800) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] for k in held) and np.mean([got[k]["predicted"] == int(k % 4 != 0) for k in held]) > 0.97


def test_class_prior():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, 5000)
    u = np.concatenate((rng.normal(2, 1, 3000), rng.normal(-3, 1, 2000)))
    assert abs(quality.class_prior(p, u) - 0.6) < 0.06


CLASHES = "tox_score _tox_score _text _u _own _doc _hash _gone _source _target hash size copies taken target gone_lines own_hash text_hash n_lines n_dropped rounds below at score x y lang_pred".split()


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(44)
    passage = prose(rng, 60)
    rows = [(k, f"{prose(rng, 20)}\n{passage}\n{prose(rng, 20)}" + " grumbat" * (k % 4 == 0), f"s{k % 3}") for k in range(60)] + ODD
    return docs(spark, rows).withColumns({c: F.lit(f"own {c}") for c in CLASHES}).cache()


def test_stages_leave_columns_of_any_name_alone(spark, clashing):
    marks = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(60)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "ten words that stand in no document at all, surely")], "item_id long, text string")
    outs = {
        "toxic": toxicity.without_toxic(clashing, marks),
        "lines": linedup.without_lines(spark, clashing),
        "copies": minhash.without_copies(spark, clashing),
        "leaks": decontamination.without_leaks(spark, clashing, bench),
    }
    for name, out in outs.items():
        assert out.columns == clashing.columns, name
        got = out.collect()
        assert got and all(r[c] == f"own {c}" for r in got for c in CLASHES), name
    added = {"size", "copies", "taken", "target", "source_size"}
    got = mixing.mix(spark, clashing).collect()
    assert len(got) == clashing.count() and all(r[c] == f"own {c}" for r in got for c in CLASHES if c not in added)


@pytest.mark.parametrize(
    "query",
    [
        lambda spark, d, lab: language.languages(d),
        lambda spark, d, lab: minhash.near_duplicates(spark, d),
        lambda spark, d, lab: media.media(spark, d),
        lambda spark, d, lab: quality.quality(d, lab),
        lambda spark, d, lab: mixing.mix(spark, d),
        lambda spark, d, lab: toxicity.toxicity(d, lab),
        lambda spark, d, lab: linedup.line_dedup(spark, d),
    ],
)
def test_a_row_in_a_row_out_whatever_other_columns(spark, clashing, labels, query):
    twice = clashing.union(clashing.where("doc_id = 4"))
    assert query(spark, twice, labels).count() == twice.count()
    assert query(spark, twice.where("false"), labels).count() == 0


def test_a_cluster_needs_a_shared_folder():
    from splicelake.llm import scratch

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        scratch.shared_dir(Session())


def test_filters_of_keys(spark):
    from splicelake.llm.textarray import bloom_of

    df = spark.range(0, 40_000, 2).select(F.xxhash64("id").alias("key")).union(spark.range(3).select(F.lit(None).cast("long").alias("key")))
    keys = np.array([r[0] for r in df.where("key is not null").collect()], np.int64).view(np.uint64)
    others = np.array([r[0] for r in spark.range(1, 40_000, 2).select(F.xxhash64("id")).collect()], np.int64).view(np.uint64)
    found = bloom_of(df, "key")
    assert found.has(keys).all() and found.has(others).mean() < 0.02
    assert not bloom_of(df.where("false"), "key").has(others).any()
