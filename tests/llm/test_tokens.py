"""op4, op5, op8: exact against the library, round trips, odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tenderfold.llm import packing, token_prefix, token_store
from tenderfold.llm.word_bpe import WordEncoder
from tests.llm.helpers import PATH, empty_docs, odd_docs, odd_rows

WORD, BYTE = PATH + "word_bpe_49k.json", PATH + "byte_bpe_50k.json"
ODD = ["İstanbul ΣΑΣ σς ΟΔΟΣ.", "école ÉCOLE ﬁ Å K", "a b c\x1cd\x85e", "don't I'LL <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>",
       "a.,b., ,, ..", "123 4a5 ¼ ²", "日本語", "", "   ", "  two  spaces \n\n\n x", "we're they'll 'r 're", "<|endoftext"]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


def test_word_encoder_equals_the_library(word):
    enc, r = WordEncoder(WORD), random.Random(3)
    alphabet = "aAbB.,'’<|>endoftxst 0١ éÉȩ́ΣσςİıßẞK  \x0b\x1f한"
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        assert enc.encode(t).tolist() == word.encode(t, add_special_tokens=False).ids, repr(t)
    assert enc.encode(None).tolist() == []


def test_prefix_counts_are_exact_at_every_prefix():
    lib, mine, r = Tokenizer.from_file(BYTE), token_prefix.PrefixCounter(BYTE), random.Random(3)
    alphabet = "aeinostr   \n\t'sltrevdm.,!-=<|>0१9 éÉ日\x1c\x85\xa0"
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 25))) for _ in range(500)]
    for t in texts:
        want = [len(lib.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)]
        assert mine.table(t).tolist() == want, repr(t)
    table = mine.table("hello wonderful world")
    assert token_prefix.fitting(table, 2) == max(i for i, n in enumerate(table) if n <= 2)


def test_budget_answers_and_tables(spark):
    lib = Tokenizer.from_file(BYTE)
    got = token_prefix.budget_answers(odd_docs(spark), BYTE, 100).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(lib.encode(r[1] or "").ids)) for r in odd_rows())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    tables = token_prefix.prefix_tables(odd_docs(spark).where("doc_id = 9"), BYTE).collect()
    assert np.frombuffer(tables[0].prefix_tokens, "<i4").tolist() == [
        len(lib.encode(odd_rows()[11][1][:k]).ids) for k in range(len(odd_rows()[11][1]) + 1)]
    assert token_prefix.budget_answers(empty_docs(spark), BYTE, 100).count() == 0


def test_elias_fano_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 2, 511, 512, 513, 3000):
        lengths = r.integers(0, 50, n) * (r.random(n) < .7)
        ids = [r.integers(0, 49000, k).astype(np.uint16) for k in lengths]
        shard = token_store.Shard(token_store.shard_bytes([None if i == 1 else i for i in range(n)], ids, 2))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        assert (shard.boundaries() == ends).all() and [shard.boundary(i) for i in range(n + 1)] == ends.tolist()
        assert all((shard.document(i) == ids[i]).all() for i in range(n))
        assert shard.no_id.tolist() == [i == 1 for i in range(n)]


def test_store_round_trip(spark, word):
    got = sorted(token_store.write_and_read(odd_docs(spark), WORD, end_id=1).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][:2] == [None, None]
    assert [r.doc_id for r in got[2:]] == sorted(r[0] for r in odd_rows() if r[0] is not None)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    want = sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in
                  ((r[0], word.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in odd_rows()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    assert token_store.write_and_read(empty_docs(spark), WORD, end_id=1).count() == 0


def _itemwise(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, x in enumerate(rooms) if x >= n]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_plan_equals_itemwise_best_fit():
    for seed in range(60):
        r = random.Random(seed)
        capacity = r.choice([5, 17, 64, 2048])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, ranks = defaultdict(list), defaultdict(list)
        for n, lo, hi, copies, first, at in packing.plan(counts, capacity):
            for k in range(lo, hi):
                used[first + (k - lo) // copies].append((at + (k - lo) % copies * n, n))
                ranks[n].append(k)
        assert {n: sorted(v) for n, v in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        for slots in used.values():
            end = 0
            for at, n in sorted(slots):
                assert at == end
                end += n
            assert end <= capacity
        assert len(used) == _itemwise(lengths, capacity)


def test_pack_documents(spark, word):
    packed = packing.pack_documents(odd_docs(spark), WORD, 0, capacity=64, with_ids=True)
    rows = packed.collect()
    want = []
    for r in odd_rows():
        ids = word.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want += [(str(r[0]), at // 64, at, ids[at:at + 64]) for at in range(0, len(ids), 64)]
    assert sorted((str(r.doc_id), r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == sorted(want)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids) for r in rows)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset:r.offset + r.length].tobytes() == bytes(r.ids)
    assert sum(map(len, whole.values())) == sum(r.length for r in rows) and max(map(len, whole.values())) <= 64
    assert packing.pack_documents(empty_docs(spark), WORD, 0).count() == 0
