"""op6, op9 and the pipeline: brute force, recall, odd rows, removability."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tenderfold.llm import decontam, line_rules, partenum, pii_crf
from tenderfold.llm.components import components
from tests.llm.helpers import empty_docs, odd_docs, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_groups(rows, size, percent):
    """{doc_id: (set size, least doc_id of its component)} by comparing all pairs."""
    low = {k: k + 32 for k in range(65, 91)}
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < size else zip(*(w[k:] for k in range(size))))))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and sets[x][0] is not None and sets[y][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(x)] = root(y)
    least = defaultdict(list)
    for x, (i, _) in enumerate(sets):
        least[root(x)].append(i)
    return sorted(((i, len(s), None if i is None else min(least[root(x)])) for x, (i, s) in enumerate(sets)), key=str)


def near_rows(seed, groups=25, copies=6):
    """Groups of copies with so many edits that similarities lie around the threshold; shared passages; tiny texts."""
    r, rows = random.Random(seed), []
    shared = prose(999, 60)
    for g in range(groups):
        base = prose(g + 1000 * seed, r.choice([3, 8, 20, 60, 200])).split()
        for _ in range(r.randint(1, copies)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = f"edit{r.randrange(10 ** 6)}"
            if r.random() < 0.3:
                w += shared.split()
            rows.append((len(rows) * 3 % 1009 + 1, " ".join(w)))
    return rows


def test_jaccard_join_equals_all_pairs(spark):
    for seed, size, percent in ((1, 4, 85), (2, 5, 80)):
        rows = near_rows(seed)
        got = partenum.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_groups(rows, size, percent)


def test_jaccard_join_takes_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = partenum.jaccard_components(odd_docs(spark))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_groups(rows, 4, 85)
    assert partenum.jaccard_components(empty_docs(spark)).count() == 0
    kept = partenum.representatives(odd_docs(spark), 5, 80)
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, 5, None, None, 8, 9, 10, 11, 12, 12, 13, 14]))
    assert kept.columns == odd_docs(spark).columns


def test_rows_of_a_repeated_id_are_judged_by_their_own_text(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(1, a), (2, a + " tail"), (2, b), (2, ""), (3, b), (4, c), (4, b + " tail"), (None, b)]
    docs = spark.createDataFrame([(t, i, "k") for i, t in rows], "text string, doc_id long, kept string")
    kept = partenum.representatives(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (2, b), (2, ""), (4, c), (None, b)], key=str)


def test_similar_sets_share_a_signature():
    r, bands = np.random.default_rng(4), partenum.Bands(85)
    for _ in range(400):
        n = int(r.integers(1, 300))
        a = np.unique(r.integers(0, 2 ** 63, n).astype(np.uint64))
        b = a.copy()
        while True:                                             # as many edits as the threshold allows
            c = np.unique(np.append(np.delete(b, r.integers(len(b))) if r.random() < .5 and len(b) > 1 else b,
                                    r.integers(0, 2 ** 63, 1).astype(np.uint64)))
            if 100 * len(np.intersect1d(a, c)) < 85 * len(np.union1d(a, c)):
                break
            b = c
        frequent = np.sort(r.choice(a, int(len(a) * r.choice([0, .3, .9, 1]))))
        assert np.intersect1d(partenum.signatures(a, bands, frequent), partenum.signatures(b, bands, frequent)).size
        size = min(len(partenum.parity_sketch(a)), len(partenum.parity_sketch(b)))
        x, y = (partenum._folded(partenum.parity_sketch(s), size) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_ROWS", 3)
    rows = near_rows(3, groups=6, copies=25)
    got = partenum.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_groups(rows, 4, 85)


def test_sets_made_together_equal_sets_made_alone(monkeypatch):
    r = random.Random(5)
    texts = [t for _, t, *_ in odd_rows()] + ["a" * 64, "a" * 65, "a" * 63 + "b", "abcdefgh", "abcdefghi", " A b\x0bC", "a b c"]
    texts += ["".join(r.choice("ab \n\tA\u00e9") for _ in range(r.randrange(60))) for _ in range(400)]
    low = {k: k + 32 for k in range(65, 91)}
    monkeypatch.setattr(partenum, "SLICE_BYTES", 300)
    for size in (1, 4):
        batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"]).slice(2)
        pairs = set()
        rows = iter(texts[2:])
        for part in partenum._slices(batch, 0):
            items, bounds = partenum.shingle_sets(part.column(0), size)
            for text, a, b in zip(part.column(0).to_pylist(), bounds[:-1], bounds[1:]):
                assert text == next(rows)
                w = WORD.findall((text or "").translate(low))
                brute = frozenset([tuple(w)] if 0 < len(w) < size else zip(*(w[k:] for k in range(size))))
                alone, _ = partenum.shingle_sets(pa.array([text], pa.string()), size)
                assert b - a == len(brute) and (items[a:b] == alone).all() and (np.diff(items[a:b].astype(object)) > 0).all()
                pairs.add((brute, items[a:b].tobytes()))
        assert next(rows, "none left") == "none left"
        assert len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


def test_signatures_made_together_lose_no_pair():
    r, bands = np.random.default_rng(6), partenum.Bands(85)
    sets = [np.unique(r.integers(0, 2 ** 64, n, dtype=np.uint64)) for n in (1, 2, 5, 30, 200, 1000, 1, 64)]
    items, bounds = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    for frequent in (items[:0], np.sort(r.choice(items, 300, replace=False)), np.sort(items)):
        sigs, number = partenum.all_signatures(items, bounds, bands, frequent)
        for i, s in enumerate(sets):
            assert sorted(sigs[number == i]) == sorted(partenum.signatures(s, bands, frequent))
            near = s[len(s) * 15 // 100:]                       # as far as the threshold allows
            assert np.intersect1d(sigs[number == i], partenum.signatures(near, bands, frequent)).size


def test_signing_costs_few_times_the_splitting_of_words():
    texts = [prose(i, 30 + i % 500) for i in range(1500)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])

    def cpu(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    split = min(cpu(lambda: [t.encode().lower().split() for t in texts]) for _ in range(5))
    task = partenum._signatures_task(4, 85, np.empty(0, np.uint64))
    assert min(cpu(lambda: list(task(iter([batch])))) for _ in range(5)) < 7 * split      # made text by text: 11 times


def test_buckets_of_the_same_members_are_compared_once(spark):
    buckets = {1: (10, 11), 2: (10, 11), 3: (10, 11, 12), 4: (10, 12), 5: (20, 21), 6: (10, 11)}
    shared = spark.createDataFrame([(s, n) for s, nodes in buckets.items() for n in nodes], "sig long, node long")
    comp = spark.createDataFrame([(20, 20), (21, 20)], "node long, component long")
    got = defaultdict(set)
    for row in partenum.JaccardJoin.mixed(None, shared, comp).collect():
        got[row.sig].add(row.node)
    assert sorted(map(sorted, got.values())) == [[10, 11], [10, 11, 12], [10, 12]]


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (200, 300)]
    chain += [(r.randrange(500, 560), r.randrange(500, 560)) for _ in range(40)]
    got = {x.node: x.component for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in chain:
        if a != b:
            parent[root(a)] = root(b)
    assert set(got) == {x for a, b in chain if a != b for x in (a, b)}
    assert len({(root(x), c) for x, c in got.items()}) == len({root(x) for x in got}) == len(set(got.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- op9
def edit_rows(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row


def test_edit_distance_to_prefix():
    r = random.Random(5)
    for _ in range(500):
        a = bytes(r.choice(b"abc") for _ in range(r.randint(1, 30)))
        b = bytes(r.choice(b"abc") for _ in range(r.randint(0, 40)))
        got, want = decontam.edit_distance_to_prefix(a, b, 10)[0], min(edit_rows(a, b[:len(a) + 10]))
        assert got == want if want <= 10 else got > 10


def edited(text, edits, r):
    x = bytearray(text)
    for _ in range(edits):
        k, o = r.randrange(1, len(x)), r.random()
        if o < .34:
            x[k] = r.choice(b"abcdefghij")
        elif o < .67:
            del x[k]
        else:
            x.insert(k, r.choice(b"abcdefghij"))
    return b" ".join(bytes(x).split())


def test_recall_at_the_edit_bound_and_no_false_match():
    r = random.Random(6)
    items = [(i, decontam.normalised(prose(50 + i, r.choice([14, 25, 40])))) for i in range(60)]
    search, docs, truth = decontam.Searcher(items), [], []
    for n in range(300):
        i, t = r.choice(items)
        mine = edited(t, decontam.allowed_edits(len(t)) if n % 2 else 0, r)
        docs.append(decontam.normalised(prose(9000 + n, 60)) + b" " + mine + b" " + decontam.normalised(prose(8000 + n, 60)))
        truth.append(i)
    found = search.search(docs)
    exact = [any(x[0] == i for x in f) for f, i in zip(found[::2], truth[::2])]
    near = [any(x[0] == i for x in f) for f, i in zip(found[1::2], truth[1::2])]
    assert all(exact) and sum(near) >= 0.9 * len(near)
    for f, d in zip(found, docs):
        words = [m.start() for m in re.finditer(rb"(?<![^ ])\S", d)]
        for item, distance, word, size, _ in f:
            text = dict(items)[item]
            assert distance <= decontam.allowed_edits(len(text))
            assert edit_rows(text, d[words[word]:words[word] + size])[-1] == distance
    assert search.search([decontam.normalised(prose(7000 + n)) for n in range(50)]) == [[]] * 50


def test_recall_of_long_items_at_the_edit_bound():
    r, per_length, share = random.Random(7), 8, {}
    for n in (394, 1000, 3000, 10000):
        items = [(i, decontam.normalised(prose(1000 * n + i, n // 3))[:n].rsplit(b" ", 1)[0]) for i in range(per_length)]
        search, hits = decontam.Searcher(items), 0
        for i, t in items:
            edits = decontam.allowed_edits(len(t)) if i else 0
            if i % 2:
                mine = bytearray(t)
                for _ in range(edits):
                    del mine[r.randrange(1, len(mine))]
                mine = b" ".join(bytes(mine).split())            # may be one deletion more
            else:
                mine = edited(t, edits, r)
            inside = decontam.distances_from(t, mine, len(t), 1)[0] <= decontam.allowed_edits(len(t))
            before = decontam.normalised(prose(9000 + i, 60))
            (found,) = search.search([before + b" " + mine + b" " + decontam.normalised(prose(8000 + i, 60))])
            hits += [x[0] for x in found] == [i] * inside
            if found:
                _, distance, word, size, places = found[0]
                assert inside and distance <= decontam.allowed_edits(len(t)) and places == 1
                assert i or (distance, word, size) == (0, before.count(b" ") + 1, len(t))
        share[n] = hits / per_length
    assert min(share.values()) >= 0.9, share


def test_distances_from_every_place_and_pieces():
    r = random.Random(9)
    for _ in range(200):
        a = bytes(r.choice(b"abc") for _ in range(r.randint(5, 30)))
        b = bytes(r.choice(b"abc") for _ in range(r.randint(8, 40)))
        got = decontam.distances_from(a, b, 6, 8)
        want = [min(edit_rows(a, b[i:])) for i in range(8)]
        assert all(g == w if w <= 6 else g > 6 for g, w in zip(got, want))
    for text in (decontam.normalised(prose(4, 900)), bytes(r.choice(b"abcdefgh") for _ in range(3000)), b"x" * 900):
        parts = decontam.pieces(text)
        assert b"".join(p for _, p in parts) == text and [at for at, _ in parts][0] == 0
    text = bytes(r.choice(b"abcdefgh") for _ in range(3000))         # one word, copied with edits and twice as it is
    docs = [b"one two " + edited(text, 100, r), text + b" " + text]
    found = decontam.Searcher([(1, text)]).search(docs)
    assert [[(x[0], x[2], x[4]) for x in f] for f in found] == [[(1, 2, 1)], [(1, 0, 2)]]


def test_classes_without_tables_are_searched_by_their_grams(monkeypatch):
    """Where sampling cannot reach the recall, the q-gram counts alone decide, and nothing is lost."""
    monkeypatch.setattr(decontam, "MOST_TABLES", 0)
    r = random.Random(8)
    items = [(i, decontam.normalised(prose(50 + i, r.choice([9, 14, 40, 90])))) for i in range(40)]
    search, docs, truth = decontam.Searcher(items), [], []
    assert set(search.table_counts) == {0}
    for n in range(120):
        i, t = r.choice(items)
        mine = edited(t, r.randrange(decontam.allowed_edits(len(t)) + 1), r)
        docs.append(decontam.normalised(prose(9000 + n, 60)) + b" " + mine + b" " + decontam.normalised(prose(8000 + n, 60)))
        truth.append((i, t, mine))
    for found, (i, t, mine) in zip(search.search(docs), truth):
        if len(t) <= decontam.STRETCH and b" " not in (mine[:1], mine[-1:]):
            assert any(f[0] == i for f in found)
    assert search.search([decontam.normalised(prose(7000 + n)) for n in range(20)]) == [[]] * 20


def test_decontamination_takes_odd_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(1, prose(3, 6000)[:300]), (2, None), (3, ""), (4, "one two three"), (4, "one two three"),
                                   (None, "zebra crossing"), (5, "x")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id) for r in decontam.matches(odd_docs(spark), bench).collect()}
    assert {(10, 1), (11, 4), (8, 5)} <= rows and not {d for d, _ in rows} & {3, 4, 5}
    kept = decontam.without_leaks(odd_docs(spark), bench)
    assert kept.schema == odd_docs(spark).schema
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id not in (13, 14)) == sorted(
        str(r[0]) for r in odd_rows() if r[0] not in (8, 10, 11, 13, 14))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 16)            # several passes, same answer
    assert {(r.doc_id, r.item_id) for r in decontam.matches(odd_docs(spark), bench).collect()} == rows
    assert decontam.matches(odd_docs(spark), bench.limit(0)).count() == 0
    assert decontam.matches(empty_docs(spark), bench).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    item = prose(77, 40)
    rows = near_rows(5, groups=12) + [(2001, prose(201) + " " + item), (2002, "Mail me@x.example.org now. " + prose(202)),
                                      (2003, "a ### b $$$ c %%% " * 30), (2004, None), (None, prose(203))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k") for i, t in r.sample(rows, len(rows))], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    one = stage["quality_rules"](spark, docs, str(tmp_path))
    judged = line_rules.judge(docs.select("doc_id", "text")).where("kept").collect()
    assert one.columns == docs.columns
    assert sorted((str(x.doc_id), x.text, x.n_chars, x.kept) for x in one.collect()) == sorted(
        (str(x.doc_id), x.clean_text, len(x.clean_text), "k") for x in judged)
    two = stage["ngram_jaccard_join"](spark, one, str(tmp_path))
    left = [(x.doc_id, x.text) for x in one.collect()]
    assert sorted(str(x.doc_id) for x in two.collect()) == sorted(
        str(i) for i, _, c in brute_groups(left, 5, 80) if i is None or i == c)
    three = stage["benchmark_decontamination"](spark, two, str(tmp_path))
    gone = {x.doc_id for x in two.collect()} - {x.doc_id for x in three.collect()}
    assert gone == {x.doc_id for x in two.collect() if decontam.normalised(item) in decontam.normalised(x.text)} and 2001 in gone
    four = stage["pii"](spark, three, str(tmp_path))
    model = pii_crf.train()
    want = [(str(x.doc_id), pii_crf.masked(x.text, pii_crf.find_all(model, [x.text])[0][1])) for x in three.collect()]
    assert sorted((str(x.doc_id), x.text) for x in four.collect()) == sorted(want)
    assert any("<EMAIL>" in t for _, t in want) and all(x.n_chars == len(x.text) for x in four.collect())
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {str(x.doc_id) for x in run} == {i for i, _ in want}
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_an_empty_table(spark, tmp_path):
    empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "some item text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
