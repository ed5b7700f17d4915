"""op11, op12 and op13 against brute force, with the odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderfold.llm import centroids, fim, suffix_dedup
from tenderfold.llm.common import join_heavy
from tests.llm.helpers import empty_docs, odd_docs, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"


# ---------------------------------------------------------------- op11
def plain_fim(doc_id, text, seed=7, rate=100, spm=50, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text, re.S)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made(docs, **kw):
    rows = fim.transform(docs, 7, **kw).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    return [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows]


def line_texts():
    r, out = random.Random(4), []
    for i in range(200):
        lines = ["".join(r.choice("aé日𝄞 \r<>PSM") for _ in range(r.randrange(12))) for _ in range(r.randrange(9))]
        out.append("\n".join(lines) + "\n" * r.randrange(3))
    return out + ["<P>x\ny", "a<M>\nb", "\n", "\n\n", "x", "x\n", "<\nP>\n<S\n>"]


def test_fim_equals_the_plain_rule(spark):
    rows = [(i, t) for i, t in enumerate(line_texts())] + [(i, t) for i, t, *_ in odd_rows()]
    docs = spark.createDataFrame(rows, DOC)
    for kw, unit in (({}, r"[^\n]*\n|[^\n]+"), ({"unit": "char"}, "."), ({"rate": 40, "spm_percent": 10}, r"[^\n]*\n|[^\n]+")):
        want = [(i, *plain_fim(i, t, rate=kw.get("rate", 100), spm=kw.get("spm_percent", 50), unit=unit), t or "") for i, t in rows]
        assert sorted(made(docs, **kw), key=str) == sorted(want, key=str)
    forms = {r[2] for r in made(docs)}
    assert forms == {"plain", "psm", "spm"}


def test_fim_slices_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(fim, "SLICE_BYTES", 64)
    rows = [(i, t) for i, t in enumerate(line_texts())]
    task = fim._transform_task("line", 100, 50)
    import pyarrow as pa
    digest = [[int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for i, _ in rows] for k in range(4)]
    batch = pa.record_batch([pa.array([i for i, _ in rows]), pa.array([t.encode() for _, t in rows], pa.binary()),
                             *(pa.array(d) for d in digest)], names=["doc_id", "text", "h1", "h2", "h3", "h4"])
    got = [r for b in task(iter([batch, batch.slice(0, 0), batch.slice(5, 9)])) for r in b.to_pylist()]
    assert [(r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"].decode()) for r in got] == [
        plain_fim(i, t) for i, t in rows + rows[5:14]]
    clash = odd_docs(spark).withColumns({c: F.lit("x") for c in ("n", "form", "output", "h1", "_hex", "prefix_chars")})
    assert len(made(clash)) == len(odd_rows())
    assert fim.transform(empty_docs(spark), 7).count() == 0


def test_select_finds_every_marked_byte():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.1, 0.6, 1.0):
        data = np.where(rng.random(1003) < share, 10, rng.integers(11, 256, 1003)).astype(np.uint8)
        padded = np.zeros(1008, np.uint8)
        padded[:1003] = data
        index = fim.UnitIndex(padded.view("<u8"), "line")
        at = np.flatnonzero(data == 10)
        assert index.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()
        assert index.rank(np.arange(1004)).tolist() == [int((at < p).sum()) for p in range(1004)]


# ---------------------------------------------------------------- op12
def plain_removals(rows, size):
    first, out = {}, []
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - size + 1):
            key = tuple(w[s:s + size])
            if i is not None and first.get(key, i) >= i:
                first[key] = i
    for i, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if i is not None and first[tuple(w[s:s + size])] < i:
                gone[s:s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def removed(docs, size):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in suffix_dedup.removals(docs, size).collect()), key=str)


def shared_rows(seed):
    """Passages that repeat within and across documents, shifted, cut short by a word, and overlapping; whole copies."""
    r = random.Random(seed)
    passages = [prose(50 + i, r.choice([7, 12, 13, 30, 55])).split() for i in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            lo = r.randrange(3)
            words += prose(1000 * seed + len(rows) * 7 + len(words), r.randrange(20)).split() + p[lo:len(p) - r.randrange(3)]
        words += ["a"] * r.choice([0, 0, 30])
        rows.append((r.randrange(40), r.choice([" ", "\n", " \t"]).join(words)))
    return rows + rows[:9] + [(100 + i, t) for i, t in rows[10:20]]


@pytest.mark.parametrize("size,least,bound", [(12, 2_000, 100_000), (12, 3, 100_000), (25, 6, 100_000), (1, 2_000, 100_000), (50, 2, 100_000)])
def test_substring_dedup_equals_all_windows(spark, monkeypatch, size, least, bound):
    monkeypatch.setattr(suffix_dedup, "HEAVY_LEAST", least)
    monkeypatch.setattr("tenderfold.llm.common.HEAVY_LEAST", least)
    rows = shared_rows(size) + [(i, t) for i, t, *_ in odd_rows()]
    docs = spark.createDataFrame(rows, DOC)
    want = plain_removals(rows, size)
    assert removed(docs, size) == [w[:4] for w in want]
    if size == 25:
        assert sorted(((r.doc_id, r.text) for r in suffix_dedup.deduplicated(docs, size).collect()), key=str) == sorted(
            ((w[0], w[4]) for w in want), key=str)


def test_a_passage_in_every_document_is_split_over_prefix_lengths(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HEAVY_LEAST", 20)
    passage = prose(77, 60)
    rows = [(i, f"{prose(3000 + i, 20)} x{i} {passage} y{i} {prose(5000 + i, 20)}") for i in range(80)]
    run = suffix_dedup.SubstringDedup(spark.createDataFrame(rows, DOC), 50)
    found = []
    heavy = suffix_dedup.SubstringDedup.heavy_prefixes
    monkeypatch.setattr(suffix_dedup.SubstringDedup, "heavy_prefixes", lambda *a: found.append(heavy(*a)) or found[-1])
    got = {r.doc_id: (r.n_removed, [(s.first, s.end) for s in r.spans]) for r in run.verdicts().collect()}
    assert len(found[0]) == 5 and found[0][-1].count() == 11                 # all windows of the passage are nodes by themselves
    assert got[0] == (0, []) and all(got[i] == (60, [(21, 81)]) for i in range(1, 80))


def test_substring_dedup_takes_clashing_columns_and_empty_tables(spark):
    assert suffix_dedup.removals(empty_docs(spark)).count() == 0
    assert suffix_dedup.deduplicated(empty_docs(spark)).count() == 0
    names = ("key", "node", "pos", "p0", "open", "least", "starts", "sha", "_group", "copies")
    docs = odd_docs(spark).withColumns({c: F.lit(1) for c in names})
    assert removed(docs, 50) == [w[:4] for w in plain_removals([(i, t) for i, t, *_ in odd_rows()], 50)]


def test_heavy_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr("tenderfold.llm.common.HEAVY_LEAST", 10)
    rows = spark.range(100).select(F.least("id", F.lit(60)).alias("k"), "id")
    side = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 0")
    got = sorted(r.id for r in join_heavy(rows, side, ["k"], "n", 100).collect())
    assert got == [i for i in range(100) if min(i, 60) % 2 == 0]


# ---------------------------------------------------------------- op13
def plain_clusters(rows, clusters, rounds, dims, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        members = [[] for _ in centres]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centres)]
    def long(x):
        return x if x < 2 ** 63 else None
    found = [(i, j, long(d)) for i, v in kept for d, j in [nearest(v)]]
    sums = [sum(d or 0 for _, j, d in found if j == c) for c in range(len(centres))]
    return sorted(((i, j, d, long(sums[j]), long(sum(sums)), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for i, j, d in found), key=str)


def vectors(seed, n, dims, spread=1.0):
    r = random.Random(seed)
    rows = [(i, [r.choice([-2, 0, 3]) * spread + r.random() * spread for _ in range(dims)]) for i in range(n)]
    return rows + [(7, rows[7][1]), (7, rows[8][1]), (900, rows[0][1]), (None, rows[1][1]), (901, None), (902, []),
                   (903, [1.0] * (dims - 1)), (904, [float("nan")] * dims), (905, [float("inf")] * dims),
                   (906, [None] * dims), (907, [-0.0] * dims)]


@pytest.mark.parametrize("spread,clusters", [(1.0, 5), (2.0 ** 17, 3), (2.0 ** 31, 3), (1.0, 500)])
def test_clusters_equal_the_plain_rounds(spark, spread, clusters):
    rows = vectors(5, 60, 6, spread)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("v", "q", "n", "cluster", "distance")})
    got = centroids.clustered(table, clusters=min(clusters, 80), rounds=3, dims=6)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_clusters(rows, min(clusters, 80), 3, 6)


def test_clusters_of_empty_tables_and_too_large_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    assert centroids.clustered(spark.createDataFrame([], schema)).count() == 0
    assert centroids.clustered(spark.createDataFrame([(1, None)], schema)).count() == 0
    with pytest.raises(ValueError):
        centroids.clustered(spark.createDataFrame([(1, [1e30])], schema), dims=1)
