"""N-gram Jaccard join by PartEnum signatures (exact).

A document is the set of its distinct word shingles. Sets of a size band
whose Jaccard similarity reaches the threshold differ in at most ``k``
shingles. The shingle domain is dealt into more than ``k`` partitions, so two
such sets agree on at least one whole partition; the hash of a partition's
content is a signature, and similar sets share one. Each set is signed for
its own band and for the next one, so pairs across a band edge meet too.

With ``spare`` more partitions than needed, ``spare + 1`` partitions agree.
An empty partition says nothing, so it is not signed, unless a set has more
empty partitions than spare ones; then all its empty partitions are signed.
Two sets that agree on empty partitions only both have more than ``spare`` of
them. So no pair is lost.

Shingles that very many documents hold (shared passages, boilerplate lines)
would fill partitions alike in unrelated documents. So the partitions are made
over the other shingles only, which loses nothing: on any part of the domain
two sets differ in at most k shingles. A set whose rest leaves more than the
spare partitions empty is signed over all its shingles as well. Which
shingles are frequent is counted over all documents; the list is bounded
(every set adds to few shingles of a given share) and only saves work.

Steps: (1) equal sets form a class, named by a hash of the set; (2) documents
are signed where they are read, so no text is shuffled: copies give equal rows,
which fall together, and signatures are combined within a task before the shuffle;
sets and signatures are made for a slice of many texts at once, in numpy, as most
texts are too short for array operations of their own;
(3) each bucket of a shared signature is a star around its least member, and
the star pairs are verified on the whole sets; then, where a bucket holds
members of several components, each member and the nearest member of each
larger component are tried as a bridge; (4) in buckets whose members are still
not all in one component, all members of different components are compared.
Most of those are not similar enough, and a parity sketch (a bit per cell that
tells whether an odd number of shingles fell into it) rules them out: two
sketches never differ in more bits than the sets in shingles. Whole sets are
made for the members of open pairs alone. Large buckets are compared in blocks
that go to different tasks, and only pairs that the sketch cannot rule out leave
a task to be verified. Similar texts share many signatures, so many buckets have
the same members (judged by their number and 128 bits of hash): one of each such
lot is compared. Nothing is capped: pairs within one component, and pairs met in
an equal bucket, are the only ones that need no answer.

Defined results: NULL or empty text, or text without words, is an empty set,
which links with nothing (component_id is its own doc_id). A row with a NULL
doc_id has a NULL component and links nothing. Repeated rows are equal sets.
Fewer words than a shingle: the whole sequence is the only shingle. Very
long texts are one set like any other. Words are compared by 64-bit hashes
and sets by 128-bit ones. An empty table gives no rows. The join reads doc_id and
text alone; ``representatives`` passes all columns through, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tenderfold.llm.common import join_heavy, staged
from tenderfold.llm.components import components

SHINGLE_WORDS = 4
THRESHOLD_PERCENT = 85
SKETCH_LEAST = 64          # bits of the smallest parity sketch; a set of n shingles has 2n to 4n bits
BLOCK_ROWS = 2_000         # members of a bucket that are compared as one block
BLOCK_BYTES = 2_000_000    # sketches of a block that are compared at once
FREQUENT_SHARE = 0.0005    # shingles of at least so many of the documents are left out of the partitions
FREQUENT_MOST = 1_000_000  # bound of that list (8 MB); a shorter list costs time, not links
COUNTED_DOCS = 4_000       # documents of a task that are counted together
COUNTED_LEAST = 3          # occurrences among them below which a shingle is not reported
BATCH_SIGNATURES = 400_000  # signatures combined at once in a task
SLICE_BYTES = 1_000_000    # text whose sets are made at once in a task
LONG_WORD = 64             # bytes of a word beyond which it is hashed by itself

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def _bounds(sizes: np.ndarray) -> np.ndarray:
    """Where stretches of these sizes, one after the other, begin and end."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of text (column number ``at``), or of one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        most = (ends[first - 1] if first else 0) + SLICE_BYTES
        past = max(first + 1, int(np.searchsorted(ends, most, side="right")))
        yield batch.slice(first, past - first)
        first = past


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (A-Z lower-cased, split at ASCII white space), and each text's number of words."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if ends[0] == ends[-1]:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    # bytes.lower() changes A-Z only; 8 spare bytes, as words are read by 8 bytes
    raw = data[int(ends[0]):int(ends[-1])].to_pybytes().lower() + bytes(8)
    ends = ends - ends[0]
    inside = ~_SPACE[np.frombuffer(raw, np.uint8)[:-8]]
    cuts = ends[(ends > 0) & (ends < len(inside))]              # a text's end is also a word's
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    eights = np.ndarray(len(raw) - 7, np.dtype("<u8"), raw, strides=(1,))
    hashes = _mix(length.astype(np.uint64) + np.uint64(1))
    hashes = _mix(hashes ^ (eights[start] & _LOW_BYTES[np.minimum(length, 8)]))
    more = np.flatnonzero(length > 8)
    for i in more[length[more] > LONG_WORD].tolist():
        hashes[i] = xxhash.xxh64_intdigest(raw[start[i]:start[i] + length[i]])
    for done in range(8, LONG_WORD, 8):
        more = more[(length[more] > done) & (length[more] <= LONG_WORD)]
        if not len(more):
            break
        rest = eights[start[more] + done] & _LOW_BYTES[np.minimum(length[more] - done, 8)]
        hashes[more] = _mix(hashes[more] ^ rest)
    return hashes, np.diff(np.searchsorted(start, ends))


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): sorted distinct 64-bit hashes of each text's shingles; those of text i lie from bounds[i] to bounds[i + 1]."""
    words, counts = _word_hashes(texts)
    width = np.minimum(counts, size)
    made = np.where(counts > 0, counts - width + 1, 0)
    bounds = _bounds(made)
    place = np.arange(bounds[-1]) + np.repeat(_bounds(counts)[:-1] - bounds[:-1], made)
    words = np.append(words, np.zeros(size, np.uint64))
    short = np.flatnonzero((counts > 0) & (counts < size))      # one shingle each, of all the words
    out = np.repeat(width, made).astype(np.uint64)
    for j in range(size):
        word = words[place + j]
        word[bounds[short[counts[short] <= j]]] = 0
        out = (out + word) * _MIX1
    out = _mix(out)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][made > 0]] = True
    return out[new], _bounds(new)[bounds]


class Bands:
    """Size bands for one threshold: band i holds sizes from starts[i] on; sizes of similar sets differ by one band at most."""

    def __init__(self, percent: int):
        self.share = Fraction(100 - percent, 100 + percent)
        self.percent = percent
        self.starts = [1]

    def band(self, n: int) -> int:
        while self.starts[-1] <= n:                 # next band: sizes that the last size of this one cannot reach
            last = self.starts[-1] * 100 // self.percent
            self.starts.append(max(last, self.starts[-1]) + 1)
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    def partitions(self, band: int) -> tuple[int, int]:
        """(partitions, spare ones) of a band's instance, which holds sets of this band and the one below."""
        while len(self.starts) <= band + 1:
            self.band(self.starts[-1])
        k = math.floor(self.share * 2 * (self.starts[band + 1] - 1))
        if k == 0:
            return 1, 0
        per = max(1.0, self.starts[max(0, band - 1)] / (k + 1))
        empty = (k + 1) * math.exp(-per)            # expected empty partitions of the smallest set here
        spare = math.ceil(empty + 4 * math.sqrt(empty)) + 1 if k > 1 else 1
        return k + 1 + min(spare, k + 1), min(spare, k + 1)

    def bands(self, sizes: np.ndarray) -> np.ndarray:
        """The bands of many sizes."""
        self.band(int(sizes.max()))
        return np.searchsorted(self.starts, sizes, side="right") - 1

    def dealt(self, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The partitions and the spare ones of many bands."""
        known, place = np.unique(bands, return_inverse=True)
        return tuple(np.array(x, np.int64)[place] for x in zip(*(self.partitions(int(b)) for b in known)))


def _name(total: np.ndarray, band: np.ndarray, slot: np.ndarray, whole: bool) -> np.ndarray:
    """The signature of a partition: its content, band and number, and whether it is made over all shingles."""
    label = ((band * 2 + whole).astype(np.uint64) << np.uint64(32)) + (slot + 1).astype(np.uint64)
    return _mix(total ^ _mix(label))


def _instance(items: np.ndarray, bounds: np.ndarray, band: np.ndarray, parts: np.ndarray, whole: bool):
    """(signature, number of the set, number of the partition) of each set's filled partitions.

    A partition is a stretch of the hashes, so it is a stretch of a sorted set.
    """
    sizes = np.diff(bounds)
    slot = ((items >> np.uint64(32)) * np.repeat(parts, sizes).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(items), bool)
    first[1:] = slot[1:] != slot[:-1]
    first[bounds[:-1][sizes > 0]] = True
    start = np.flatnonzero(first)
    total = np.add.reduceat(items, start) if len(start) else items
    number, slot = np.repeat(np.arange(len(sizes)), np.diff(np.searchsorted(start, bounds))), slot[start]
    return _name(total, band[number], slot, whole), number, slot


def _chosen(items: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets that are marked in ``which``."""
    sizes = np.diff(bounds)
    return items[np.repeat(which, sizes)], _bounds(sizes[which])


def all_signatures(items: np.ndarray, bounds: np.ndarray, bands: Bands, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, number of the set) of non-empty sets: one per filled partition of its band's and the next band's instance."""
    own, out = bands.bands(np.diff(bounds)), []
    rest, rest_bounds = items, bounds
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
        keep = frequent[at] != items
        rest, rest_bounds = items[keep], _bounds(keep)[bounds]
    for band in (own, own + 1):
        parts, spare = bands.dealt(band)
        sigs, number, _ = _instance(rest, rest_bounds, band, parts, False)
        out.append((sigs, number))
        few = parts - np.bincount(number, minlength=len(parts)) > spare
        if not few.any():
            continue
        ids = np.flatnonzero(few)
        band, parts, spare = band[few], parts[few], spare[few]
        sigs, number, slot = _instance(*_chosen(items, bounds, few), band, parts, True)
        out.append((sigs, ids[number]))
        empty = np.repeat(parts - np.bincount(number, minlength=len(parts)) > spare, parts)
        place = _bounds(parts)
        empty[place[number] + slot] = False
        number = np.repeat(np.arange(len(parts)), parts)[empty]
        slot = np.flatnonzero(empty) - place[number]
        out.append((_name(np.zeros(len(slot), np.uint64), band[number], slot, True), ids[number]))
    return tuple(np.concatenate(x) for x in zip(*out))


def signatures(s: np.ndarray, bands: Bands, frequent: np.ndarray) -> np.ndarray:
    """All signatures of one non-empty set."""
    return all_signatures(s, np.array([0, len(s)]), bands, frequent)[0]


def _set_keys(items: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(items[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _node(key: bytes) -> int:
    """The name of a class: among 10 billion different sets about three pairs share one."""
    return int.from_bytes(key[:8], "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(node, set) of rows (node, text, key); a text whose set has another key belongs to a repeated doc_id."""
    for batch in batches:
        for part in _slices(batch, 1):
            items, bounds = shingle_sets(part.column(1), size)
            for i, (node, key, own) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), _set_keys(items, bounds))):
                if key == own:
                    yield node, items[bounds[i]:bounds[i + 1]]


def parity_sketches(items: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """One bit per cell: whether an odd number of shingles fell into it; cells are a power of two."""
    sizes = np.diff(bounds)
    cells = np.array([max(SKETCH_LEAST, 1 << (2 * n - 1).bit_length()) if n else SKETCH_LEAST for n in sizes.tolist()], np.int64)
    place = _bounds(cells)
    at = (items & np.repeat(cells - 1, sizes).astype(np.uint64)).astype(np.int64) + np.repeat(place[:-1], sizes)
    bits = np.packbits(np.bincount(at, minlength=place[-1]) & 1, bitorder="little").tobytes()
    return [bits[a:b] for a, b in zip((place[:-1] // 8).tolist(), (place[1:] // 8).tolist())]


def parity_sketch(s: np.ndarray) -> bytes:
    """The sketch of one set."""
    return parity_sketches(s, np.array([0, len(s)]))[0]


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with fewer cells."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which sketches of equal width differ: never more than the sets differ in shingles."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _close(apart: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and sketches leave open that the sets reach the threshold."""
    return (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent) & (apart * (100 + percent) <= (na + nb) * (100 - percent))


def _classes_task(size: int):
    """One row per document (set size, key, sketch), and rows of n = -1 that report locally frequent shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}

        def rows(ids: list | pa.Array, ns: list | np.ndarray, keys: list, sketches: list, common: list) -> pa.RecordBatch:
            nodes = [None if k is None else _node(k) for k in keys]
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()),
                                    pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()),
                                    pa.array(common, pa.map_(pa.int64(), pa.int64()))],
                                   names=["doc_id", "n", "key", "node", "sketch", "common"])

        def report() -> pa.RecordBatch:
            items, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
            often = counts >= COUNTED_LEAST
            found = list(zip(items[often].view(np.int64).tolist(), counts[often].tolist()))
            seen.clear()
            return rows([None], [-1], [None], [None], [found])

        for batch in batches:
            for part in _slices(batch, 1):
                items, bounds = shingle_sets(part.column(1), size)
                keys = _set_keys(items, bounds)
                for key, a, b in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist()):
                    if a < b:
                        seen[key] = items[a:b]                  # copies count once
                yield rows(part.column(0), np.diff(bounds), keys, parity_sketches(items, bounds), [None] * len(keys))
                if len(seen) >= COUNTED_DOCS or sum(map(len, seen.values())) > 4_000_000:
                    yield report()
        if seen:
            yield report()
    return run


def _signatures_task(size: int, percent: int, frequent: np.ndarray):
    """Signatures of each document, combined: one row per signature with its least member and the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, sigs, nodes, held = Bands(percent), [], [], 0
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            sig, node = np.concatenate(sigs), np.concatenate(nodes)
            order = np.argsort(sig)
            sig, node = sig[order], node[order]
            first = np.ones(len(sig), bool)
            first[1:] = sig[1:] != sig[:-1]
            start = np.flatnonzero(first)
            least = np.minimum.reduceat(node, start)
            other = node != np.repeat(least, np.diff(np.append(start, len(sig))))
            counts = np.add.reduceat(other, start, dtype=np.int64)
            others = pa.ListArray.from_arrays(pa.array(_bounds(counts).astype(np.int32)), pa.array(node[other]))
            return pa.record_batch([pa.array(sig[first].view(np.int64)), pa.array(least), others],
                                   names=["sig", "node", "others"])

        for batch in batches:
            for part in _slices(batch, 0):
                items, bounds = shingle_sets(part.column(0), size)
                names = np.array([_node(k) for k in _set_keys(items, bounds)], np.int64)
                which = np.zeros(len(names), bool)
                for i in np.flatnonzero(np.diff(bounds)).tolist():
                    if names[i] not in seen:                # a copy is signed once
                        seen.add(int(names[i]))
                        which[i] = True
                if not which.any():
                    continue
                got, number = all_signatures(*_chosen(items, bounds, which), bands, frequent)
                sigs.append(got)
                nodes.append(names[which][number])
                held += len(got)
                if held >= BATCH_SIGNATURES:
                    yield flush()
                    sigs, nodes, held = [], [], 0
                    seen.clear()
        if held:
            yield flush()
    return run


def _buckets_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (sig, node): (sig, centre, member) for each bucket of two or more members.

    Only the last row is carried between batches, whatever a bucket's size.
    """
    last_sig = last_centre = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column(0).to_numpy(zero_copy_only=False)
        node = batch.column(1).to_numpy(zero_copy_only=False)
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        start = np.flatnonzero(first)
        centres = node[start].copy()
        if last_sig is not None and sig[0] == last_sig:
            centres[0] = last_centre
        centre = np.repeat(centres, np.diff(np.append(start, len(sig))))
        others = batch.column(2)
        sizes = np.diff(others.offsets.to_numpy())
        flat = others.flatten().to_numpy(zero_copy_only=False)
        own = node != centre
        last_sig, last_centre = sig[-1], centre[-1]
        out_sig = np.concatenate([sig[own], np.repeat(sig, sizes)])
        out_centre = np.concatenate([centre[own], np.repeat(centre, sizes)])
        member = np.concatenate([node[own], flat])
        keep = member != out_centre
        yield pa.record_batch([pa.array(out_sig[keep]), pa.array(out_centre[keep]), pa.array(member[keep])],
                              names=["sig", "centre", "member"])


def _sets_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sets, held = [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                   names=["node", "items"])

        for node, s in _sets(batches, size):
            nodes.append(node)
            sets.append(s.view(np.int64))
            held += len(s)
            if held >= BATCH_SIGNATURES:
                yield flush()
                nodes, sets, held = [], [], 0
        if nodes:
            yield flush()
    return run


def _possible_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(i) for i in range(6))
            open_ = []
            for x, y, m, n in zip(sa.to_pylist(), sb.to_pylist(), na.to_pylist(), nb.to_pylist()):
                width = min(len(x), len(y))
                open_.append(bool(_close(_apart(_folded(x, width), _folded(y, width)), m, n, percent)))
            keep = pa.array(open_, pa.bool_())
            yield pa.record_batch([a.filter(keep), b.filter(keep)], names=["a", "b"])
    return run


def _across_task(percent: int, nearest: bool):
    """Pairs (a, b) of one block pair in different components that sizes and sketches leave open.

    With ``nearest`` only the nearest one (by the sketches) of each member and
    each component that is larger in this block pair: one link joins them.
    Rows come sorted by (sig, block, other); a member's side is 0 or 1 where
    two blocks meet. A block holds about BLOCK_ROWS rows, whatever the bucket.
    """
    def pairs(rows: list[tuple]) -> np.ndarray | None:
        node, comp, n, sketch, side = zip(*rows)
        width = min(map(len, sketch))
        m = np.stack([_folded(x, width) for x in sketch])
        node, comp, n, side = (np.array(x) for x in (node, comp, n, side))
        two, place = side.any(), np.arange(len(node))
        _, number, count = np.unique(comp, return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((np.arange(len(count)), count))] = np.arange(len(count))
        rank = rank[number]                                   # larger components have higher ranks
        left, right = [], []
        step = max(1, BLOCK_BYTES // (len(node) * width))
        for first in range(0, len(node), step):
            some = place[first:first + step, None]
            # each pair is looked at from one of its ends
            ok = (rank > rank[some]) if nearest else (comp != comp[some]) & (place > some)
            if two:
                ok &= side != side[some]
            i, at = np.nonzero(ok)
            near = np.minimum(n[at], n[i]) * 100 >= np.maximum(n[at], n[i]) * percent
            i, at = i[near] + first, at[near]
            apart = _apart(m[at], m[i])
            close = _close(apart, n[at], n[i], percent)
            i, at, apart = i[close], at[close], apart[close]
            if nearest and len(at):
                order = np.lexsort((apart, rank[at], i))
                i, at = i[order], at[order]
                best = np.r_[True, (np.diff(rank[at]) != 0) | (np.diff(i) != 0)]
                i, at = i[best], at[best]
            left.append(np.minimum(node[at], node[i]))
            right.append(np.maximum(node[at], node[i]))
        if not sum(map(len, left)):
            return None
        return np.stack([np.concatenate(left), np.concatenate(right)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held, size = None, [], [], 0

        def flush() -> pa.RecordBatch:
            both = np.unique(np.concatenate(held, axis=1), axis=1)      # a pair meets in many buckets
            return pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        def groups() -> Iterator[list[tuple]]:
            nonlocal key, rows
            for batch in batches:
                for *group, node, comp, n, sketch, side in zip(*(c.to_pylist() for c in batch.columns)):
                    if group != key:
                        yield rows
                        key, rows = group, []
                    rows.append((node, comp, n, sketch, side))
            yield rows

        for members in groups():
            if len(members) > 1 and (out := pairs(members)) is not None:
                held.append(out)
                size += out.shape[1]
                if size >= BATCH_SIGNATURES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


class JaccardJoin:
    """One run of the join over ``docs`` (doc_id long, text string)."""

    def __init__(self, docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT):
        self.size, self.percent = size, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        # one small row per document: set size, set key, class, sketch of counters
        rows = staged(self.docs.mapInArrow(_classes_task(size), "doc_id long, n long, key binary, node long, sketch binary, "
                                           "common map<long,long>"), "members")
        self.members = rows.where("n >= 0").drop("common", "sketch", "node")
        filled = rows.where("n > 0 and doc_id is not null")
        self.total = filled.count()
        self.classes = staged(filled.groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("node").alias("node"),
            F.count("*").alias("copies")), "classes")
        self.frequent = self._frequent(rows)
        self.repeated = not self.members.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty()

    def _frequent(self, rows: DataFrame) -> np.ndarray:
        """Sorted hashes of the frequent shingles: sets of n shingles on average have n / share of them at most."""
        least = max(COUNTED_LEAST, int(self.classes.count() * FREQUENT_SHARE))
        counted = rows.where("n = -1").select(F.explode("common").alias("item", "n")).groupBy("item").agg(F.sum("n").alias("n"))
        top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "item").limit(FREQUENT_MOST).select("item")
        got = top.toPandas()["item"].to_numpy(dtype=np.int64)
        return np.sort(got.view(np.uint64))

    def buckets(self) -> DataFrame:
        """(sig, centre, member) of every signature that two or more classes share."""
        rows = self.docs.where("doc_id is not null").select("text").mapInArrow(
            _signatures_task(self.size, self.percent, self.frequent), "sig long, node long, others array<long>")
        dealt = rows.repartition("sig").sortWithinPartitions("sig", "node")
        return dealt.mapInArrow(_buckets_task, "sig long, centre long, member long")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """node, items of the classes in the pairs; the text of each class comes from its first document."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = staged(self.classes.join(nodes, "node", "left_semi").select(F.col("rep").alias("doc_id"), "node", "key"), "wanted")
        # the list grows with the corpus: joined by a shuffle at every size
        texts = self.docs.join(wanted.hint("shuffle_merge"), "doc_id").select("node", "text", "key")
        made = texts.mapInArrow(_sets_task(self.size), "node long, items array<long>")
        return staged(made.dropDuplicates(["node"]) if self.repeated else made, "sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets reach the threshold."""
        if pairs.isEmpty():
            return pairs
        sets = self.sets(pairs)
        a = sets.select(F.col("node").alias("a"), F.col("items").alias("xa"))
        b = sets.select(F.col("node").alias("b"), F.col("items").alias("xb"))
        both = pairs.join(b, "b").join(a, "a")
        shared = F.size(F.array_intersect("xa", "xb"))
        scored = both.select("a", "b", shared.alias("i"), (F.size("xa") + F.size("xb")).alias("t"))
        return scored.where(f"100 * i >= {self.percent} * (t - i)").select("a", "b")

    def sketches(self) -> DataFrame:
        """node, n, sketch of every class; it grows with the corpus, so it is joined by a shuffle at every size."""
        return self.classes.select("node", "n", "sketch").hint("shuffle_merge")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the sizes and the sketches do not rule out (lossless)."""
        c = self.sketches()
        a = c.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        b = c.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        both = pairs.join(b, "b").join(a, "a").where(
            F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_possible_task(self.percent), "a long, b long")

    def across(self, mixed: DataFrame, nearest: bool) -> DataFrame:
        """Pairs of a bucket that lie in different components and are not ruled out, block by block: the nearest or all."""
        sized = mixed.join(mixed.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "sig")
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        rows = (sized.join(self.sketches(), "node").withColumn("own", own)
                .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("sig", F.least("own", "met").alias("block"), F.greatest("own", "met").alias("other"),
                        "node", "component", "n", "sketch", (F.col("own") > F.col("met")).cast("int").alias("side")))
        dealt = rows.repartition("sig", "block", "other").sortWithinPartitions("sig", "block", "other")
        return dealt.mapInArrow(_across_task(self.percent, nearest), "a long, b long").distinct()

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(links a-b between classes that suffice for the components, node -> component)."""
        buckets = staged(self.buckets(), "buckets")
        stars = buckets.select(F.col("centre").alias("a"), F.col("member").alias("b")).distinct()
        candidates = staged(self.possible(stars), "pairs")
        shared = staged(buckets.select("sig", F.col("centre").alias("node")).unionByName(
            buckets.select("sig", F.col("member").alias("node"))).distinct(), "shared")
        found = staged(self.verified(candidates), "found")
        comp = components(found)
        # one link is enough to join two components: the nearest members first, then all that is left
        for nearest in (True, False):
            more = staged(self.verified(staged(self.across(self.mixed(shared, comp), nearest), "pairs")), "found")
            found, comp = found.unionByName(more), self.joined(comp, more)
        return found, comp

    def mixed(self, shared: DataFrame, comp: DataFrame) -> DataFrame:
        """(sig, node, component) of the different buckets whose members are in several components."""
        labelled = staged(shared.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled")
        spread = labelled.groupBy("sig").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
        # many signatures are shared by the same members: one bucket of each lot is compared
        one = spread.where("lo != hi").groupBy("lo", "hi", "members", "x", "y").agg(F.min("sig").alias("sig"))
        return labelled.join(one.select("sig"), "sig")

    @staticmethod
    def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
        """The components after more links: components of the components."""
        if links.isEmpty():
            return comp
        name = comp.select("node", "component")
        ends = links.join(name.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
            name.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left").select(
            F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        above = components(ends).withColumnRenamed("component", "above")
        old = name.join(above.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("above", "component").alias("component"))
        new = above.select("node", F.col("above").alias("component")).join(name, "node", "left_anti")
        return staged(old.unionByName(new), "components")

    def groups(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row of the input."""
        return self.keyed_groups().drop("key")

    def keyed_groups(self) -> DataFrame:
        """The groups with the key of each row's set."""
        found, comp = self.links()
        c = self.classes.join(comp, "node", "left").select(
            "key", "rep", "copies", F.coalesce("component", "node").alias("component"))
        least = c.groupBy("component").agg(F.min("rep").alias("component_id"))
        named = staged(c.join(least, "component").select("key", "component_id", "copies"), "named")
        # exact copies of one text are one key
        linked = join_heavy(self.members.where("n > 0 and doc_id is not null"), named, ["key"], "copies", self.total).select(
            "doc_id", F.col("n").alias("n_shingles"), "component_id", "key")
        alone = self.members.where("n = 0 or doc_id is null").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "key")
        return linked.unionByName(alone)


def jaccard_components(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Group documents whose shingle sets reach the threshold, over all rows of ``docs``."""
    return JaccardJoin(docs, size, percent).groups()


def _keys_task(size: int, at: int):
    """The rows with the key of the set of their text (column number ``at``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, at):
                keys = _set_keys(*shingle_sets(part.column(at), size))
                yield pa.record_batch([*part.columns, pa.array(keys, pa.binary())], names=[*part.schema.names, "_key"])
    return run


def representatives(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the document with the least doc_id stays.

    Rows with a NULL doc_id, and sets without words, belong to no group and
    stay. Of rows that repeat both doc_id and text, one stays. Rows of one
    doc_id with different texts are judged each by its own text.
    """
    join = JaccardJoin(docs, size, percent)
    copies = join.keyed_groups().where("doc_id != component_id").select("doc_id", "key").distinct()
    rows = docs.select(F.struct("*").alias("row"))            # whatever the names of its columns
    if not join.repeated:
        gone = staged(copies.select(F.col("doc_id").alias("gone")), "copies")
        return rows.join(gone, F.col("row.doc_id") == F.col("gone"), "left_anti").select("row.*")
    known = rows.where("row.doc_id is not null").withColumns({"id": F.col("row.doc_id"), "text": F.col("row.text")})
    rows = rows.where("row.doc_id is null").unionByName(known.dropDuplicates(["id", "text"]).select("row"))
    keyed = rows.select("row", F.col("row.text").cast("string").alias("text")).mapInArrow(_keys_task(size, 1), StructType(
        [StructField("row", docs.select(F.struct("*").alias("row")).schema["row"].dataType), StructField("text", StringType()),
         StructField("_key", BinaryType())]))
    gone = staged(copies.select(F.col("doc_id").alias("gone"), F.col("key").alias("gone_key")), "copies")
    return keyed.join(gone, (F.col("row.doc_id") == F.col("gone")) & (F.col("_key") == F.col("gone_key")), "left_anti").select("row.*")
