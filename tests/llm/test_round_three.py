"""Exact top-k, fill-in-middle and the filter audit, against brute force and over odd tables."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from test_operators import docs as sourced
from test_operators import prose

from splicelake.llm import decontamination, filteraudit, fillmiddle, labelled, metrictree, warc
from splicelake.llm.scratch import Scratch

CLASHES = "qkey block page node cell rank score n form output sha made part twin A B C D E docs good toxic subset step first dealt words".split()


def clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


# ---- top-k


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def plain_top(rows, wanted, k=10):
    held = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            held.setdefault((i, tuple(int(np.floor(1024 * c)) for c in x)))
    out = []
    for qi, q in held:
        if wanted(qi):
            scores = [(-sum(a * b for a, b in zip(q, c)), i) for i, c in held if i != qi]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def top(spark, rows, modulo=5, k=10, frame=None):
    got = metrictree.top_k(spark, vectors(spark, rows) if frame is None else frame, F.col("vec_id") % modulo == 0, k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def clustered(seed, n, dims=6, groups=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, dims))
    return [(k, [float(c) for c in centres[rng.integers(groups)] + rng.normal(0, 0.05, dims)]) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_of_clusters(spark, monkeypatch, seed):
    for name, value in (("PAGE_ROWS", 40), ("LEAF_ROWS", 6), ("BLOCK_ROWS", 9), ("PAGES_A_TASK", 2)):
        monkeypatch.setattr(metrictree, name, value)
    rows = clustered(seed, 600)
    rows += [(1000 + k, rows[k % 3][1]) for k in range(200)]  # copies of three, far more than k
    rows += [(2000 + k, [c * 3 for c in rows[k][1]]) for k in range(30)]  # some much longer
    assert top(spark, rows) == plain_top(rows, lambda i: i % 5 == 0)


def test_top_k_of_odd_rows(spark):
    rows = [
        (0, [0.5, -0.25]), (5, [0.5, -0.25]), (5, [0.5, -0.25]), (10, [0.0, 0.0]), (15, []), (1, [1.0]), (2, None), (None, [9.0, 9.0]), (3, [float("nan"), 1.0]), (20, [float("inf"), 0.0]),
        (4, [None, 1.0]), (25, [-0.0001, 0.0001]), (25, [2.0, 0.0, 1.0]),
    ]
    want = plain_top(rows, lambda i: i % 5 == 0)
    assert {r[0] for r in want} == {0, 5, 10, 15, 25}
    assert top(spark, rows) == want
    assert top(spark, None, frame=clashing(vectors(spark, rows))) == want
    assert top(spark, None, frame=vectors(spark, rows).where("false")) == []
    assert top(spark, [(0, [1.0, 2.0])]) == []
    huge = [*rows, (30, [1e30, 0.0]), (35, [1e6, 1e6])]
    assert {r[0] for r in top(spark, huge)} == {0, 5, 10, 15, 25, 35}


def test_bounds_spare_most_distances():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1000, (40, 16))
    v = np.concatenate([c + rng.normal(0, 20, (50, 16)) for c in centres]).astype(np.int64)
    top_ = float((v.astype(float) ** 2).sum(1).max())
    points = metrictree.lifted(v, top_)
    routes = points[metrictree.medoids(points, 1)]
    nodes = metrictree.page_of(0, 0, np.arange(len(v)), v, metrictree.distances(points, routes)[:, 0], routes[0], top_)
    assert sum(x[3] for x in nodes if x[1] >= 0) == len(v) and len(nodes) > 20
    for x in nodes[1:]:  # covering radii and stored distances hold
        own = np.frombuffer(x[10], np.int64).reshape(x[3], -1)
        d = metrictree.distances(metrictree.lifted(own, top_), np.frombuffer(x[8])[None])[:, 0]
        assert (d <= x[6] + 1e-3).all() and np.allclose(d, np.frombuffer(x[11]), atol=1e-3)
    spent = 0
    for k in range(0, 2000, 100):
        best, n = metrictree.search(v[k : k + 1], np.array([k]), np.array([np.iinfo(np.int64).min]), nodes, top_, 10)
        scores = v @ v[k]
        want = sorted((i for i in range(len(v)) if i != k), key=lambda i: (-scores[i], i))[:10]
        assert best.ids[0].tolist() == want
        spent += n
    assert spent < 0.5 * 20 * len(v)


# ---- fill in middle


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


ODD = [(None, "two words", None), (1, None, "en"), (2, "", "en"), (3, " \t\n", "en"), (4, "word", None), (5, "holds <M> a mark", "de"), (6, "é\U0001f600 ü x  tail ", "de"), (6, "é\U0001f600 ü x  tail ", "de"), (7, "a b " * 40_000, "en")]


def plain_fim(i, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle(spark):
    rng = random.Random(3)
    rows = [*ODD, *((100 + k, " ".join(rng.choice(["ab", "ç", "  ", "\n", "<P", "S>", "<", ">", "x" * 30]) for _ in range(rng.randrange(1, 60))), "en") for k in range(300))]
    got = fillmiddle.transform(clashing(docs(spark, rows))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *plain_fim(i, t))) for i, t, _ in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    texts = {i: t or "" for i, t, _ in rows}
    assert all(fillmiddle.restore(r["output"], r["form"]) == texts[r["doc_id"]] for r in got)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in fillmiddle.fill_middle(docs(spark, rows)).collect():
        *_, output = plain_fim(r["doc_id"], texts[r["doc_id"]])
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(output), sha(texts[r["doc_id"]]))
    assert fillmiddle.fill_middle(docs(spark, rows).where("false")).count() == 0


def test_units_cover_a_text():
    for text in ("", " a", "a ", "   a\x0b\x0cb\x1c", "\n\n"):
        ends = fillmiddle.unit_ends(text)
        assert (ends[-1] if ends else 0) == len(text) and list(ends) == [m.end() for m in regex.finditer(fillmiddle.UNIT, text)]


# ---- filter audit


def plain_audit(rows, labels):
    def mark(i, k):
        return any(x[k] == 1 for x in labels if x[0] is not None and x[0] == i)

    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    held = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        held.append((lang or "", {f for f in failed if failed[f]}, mark(i, 1), mark(i, 2)))
    out = {}
    for part in {h[0] for h in held}:
        own = [h for h in held if h[0] == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for k, f in enumerate(order):
                gone, kept = [h for h in left if f in h[1]], [h for h in left if f not in h[1]]
                out[part, "".join(order), k + 1] = [len(kept), len(gone), sum(f in h[1] for h in own) - len(gone), sum(h[1] == {f} for h in own), sum(h[2] for h in gone), sum(h[3] for h in gone)]
                left = kept
    for part, order, k in list(out):
        out[part, order, k].append(sum(x[1] for (p, o, j), x in out.items() if p == part and o[j - 1] == order[k - 1] and len(x) >= 6))
    return out


def test_filter_audit(spark):
    rng = random.Random(8)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split() + [f"w{k}" for k in range(300)]
    text = lambda: " ".join(rng.choice(words[: rng.choice([5, 310])]) for _ in range(rng.choice([20, 199, 200, 400]))) + rng.choice(["", "", " $", " AAAA" * 12])
    rows = [*ODD, *((100 + k, text(), rng.choice(["en", "de", None])) for k in range(60))]
    rows += [(200 + k, rows[20 + k % 7][1], "fr") for k in range(20)] + [(None, rows[20][1], "fr"), (100, rows[9][1], "en")]
    labels = [(100 + k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 110, 2)] + [(102, 1, 0), (None, 1, 1), (999, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(clashing(docs(spark, rows)), frame.withColumns({c: F.lit(1) for c in ("part", "twin", "dealt", "lang", "text")}), Scratch(spark, "t")).collect()
    want = plain_audit(rows, labels)
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in got} == want and len(got) == len(want) == 600 * 4
    assert filteraudit.audit(docs(spark, rows).where("false"), frame, Scratch(spark, "t")).count() == 0
    assert filteraudit.audit(docs(spark, rows), frame.where("false"), Scratch(spark, "t")).where("good_lost + toxic_lost > 0").count() == 0


def test_samples_are_bounded_by_rows(spark):
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0)], "doc_id long, toxic int")
    one = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    same = spark.range(20_000).select(F.lit(8).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    every = F.col("doc_id").isNotNull()
    n = labelled.sample(one.union(same), labels, "toxic", every, Scratch(spark, "t"), rows=100).count()
    assert 20 < n < 400
    got = labelled.sample(same.union(one.limit(50)), labels, "toxic", every, Scratch(spark, "t"), rows=100).collect()
    assert len(got) == 51 and sum(r["doc_id"] == 8 for r in got) == 1


def test_leaks_go_by_text_whatever_the_ids(spark):
    rng = random.Random(31)
    item = "what is the longest river that runs through seven lands of the north and ends in a salt lake answer: the grey river"
    leak, fine = f"{prose(rng, 30)} {item} {prose(rng, 20)}", prose(rng, 60)
    rows = [(None, leak, "s"), (None, fine, "s"), (1, leak, "s"), (1, fine, "s"), (2, fine, "s"), (2, None, "s"), (3, leak, "s"), (3, leak, "s"), (None, None, "s")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontamination.without_leaks(spark, sourced(spark, rows), bench).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(str((i, t)) for i, t, _ in rows if t != leak)
    none = bench.where("false")
    assert decontamination.without_leaks(spark, sourced(spark, rows), none).count() == len(rows)


# ---- archives of other writers


def record(version, kind, payload, http=True, extra=""):
    block = (b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" if http else b"") + payload
    head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{len(payload)}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "300"])
def test_archives_that_others_wrote(spark, tmp_path, split):
    import gzip

    inner = record("1.0", "response", b"not a record")
    payloads = [b"one", b"", inner + b" WARC/1. and more", "é".encode() * 300, inner * 3]
    plain = b"".join(record("1.0", "response", p, extra="Content-Type: application/http\r\n") for p in payloads)
    newer = b"".join(record("1.1", "response", p) for p in payloads[::-1])
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "CRAWL-0001.warc").write_bytes(plain)
    (tmp_path / "a" / "CRAWL-0002.warc.gz").write_bytes(b"".join(gzip.compress(record("1.0", "response", p)) for p in payloads))
    (tmp_path / "a" / "part-1.txt").write_bytes(newer)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read(spark, str(tmp_path / "a"), Scratch(spark, "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sha = lambda p: hashlib.sha1(p).hexdigest()
    for name in ("CRAWL-0001.warc", "CRAWL-0002.warc.gz", "part-1.txt"):
        assert sorted(r["sha"] for r in got if r["file"].endswith(name)) == sorted(map(sha, payloads)), name
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.warc").write_bytes(record("2.0", "response", b"one"))
    with pytest.raises(ValueError, match="doesn't begin with a WARC record"):
        warc.read(spark, str(tmp_path / "b"), Scratch(spark, "w"))
