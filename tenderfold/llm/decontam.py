"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and items are lower-cased and their white space is made one space. A
document leaks an item if some stretch of it that starts at a word is within
``EDIT_PERCENT`` edits (of the item's length, counted on UTF-8 bytes).

An item of more than ``STRETCH`` bytes is looked for by several stretches of
at most about that size, which begin at its words and together make up the
item: if the item has k edits, one of them has no more than its share of k.
(Walks drift apart with every edit, so one walk over a long item would seldom
agree.) In a word of more than ``LONG_WORD`` bytes stretches also begin at
places chosen by the bytes there. Below, a piece is such a stretch or a whole
shorter item.

The windows to compare are the stretches of a piece's size at every word.
(1) A window within k edits of a piece of length L keeps at least
L - q + 1 - k q of its q-grams, so a window in which fewer of its q-grams
belong to any piece is ruled out (lossless). (2) The CGK random walk reads a
window with a pointer that stays or moves on by a random function of step and
character; what it reads at each step is the embedding, and few edits change
few steps. The walk of a window does not depend on where the window ends, so
one walk serves all sizes. (3) Bit sampling draws ``BITS`` steps of the
walk per table, among the steps that stay inside the shortest piece of a size
class; windows and pieces that agree on them in any table are candidates. The
number of tables per walk follows, for each size class, from the target recall
and the agreement measured on edited copies of its pieces at the edit bound
(the least of mixed edits, replacements, deletions and insertions);
``WALKS`` independent walks are drawn. A class that would need more than
``MOST_TABLES`` (its walks seldom agree) takes none: there every window that
keeps enough q-grams of one piece is a candidate for it, which loses nothing.
(4) Every candidate is verified by the exact edit distance of the item to the
best-ending stretch at that word. If a piece of a longer item is found, the
item is compared at every word at which it could begin.

All documents are read in one pass without a shuffle; the items are the stated
query set. They go to the tasks in blocks of bounded size, one pass for each.

Defined results: NULL or empty texts and items match nothing. Items with equal
text are all reported. Rows are one per document and item, with the least
distance, the first such place and the number of separate places (of
overlapping places of a longer item the one with the least distance counts). A
repeated doc_id is reported once per row. An empty table gives no rows.
``matches`` reads doc_id and text alone; ``without_leaks`` passes all columns
through, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

EDIT_PERCENT = 5
GRAM = 10                   # longest q-gram of the window filter; shorter for short items
RECALL = 0.97               # of the sampling, for a pair at the edit bound
TRIALS = 200                # edited copies per kind of edit by which a size class measures its agreement
MOST_TABLES = 40            # per walk; classes that would need more are searched by their q-grams alone, without sampling
BITS = 5                    # sampled steps per table
WALKS = 5
STRETCH = 112               # longer items are looked for by stretches of at most about this size
LONG_WORD = 64              # longer words have places inside at which a stretch may begin
CLASS_RATIO = 1.5           # longest over shortest item of a size class
BLOCK_BYTES = 8 << 20       # items per pass
GROUP = 1 << 16             # short documents are searched together up to so many bytes (their arrays stay in cache)
SECTION = 1 << 20           # bytes of a long document that are searched at once
GRAM_TABLE_BITS = 20        # at least; the table grows with the block of items
KEPT_SEARCHERS = 2          # a worker keeps the indexes of so many blocks for its next tasks

_K = np.uint64(0x9E3779B97F4A7C15)
_K32 = 0x9E3779B1


def normalised(text: str | None) -> bytes:
    """Lower case, words separated by one space (ASCII white space)."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())


def allowed_edits(length: int) -> int:
    return length * EDIT_PERCENT // 100


def _gram_hashes(b: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of the q bytes at each place, by joining hashes of halves."""
    n = len(b) - q + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    power = {1: b.astype(np.uint32)}
    size = 1
    while size * 2 <= q:
        h = power[size]
        joined = h[:-size] * np.uint32(_K32 + 2 * size)
        joined += h[size:] ^ (h[size:] >> np.uint32(15))
        power[size * 2] = joined
        size *= 2
    out, at = power[size][:n], size
    while at < q:
        while at + size > q:
            size //= 2
        out = out * np.uint32(_K32 + 2 * at + 16)
        out += power[size][at:at + n]
        at += size
    return (out ^ (out >> np.uint32(16))) * np.uint32(0x85EBCA6B)


@lru_cache(maxsize=50_000)
def _places(item: bytes) -> dict[int, int]:
    """For each byte, the bit set of its places in the item."""
    places: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        places[c] |= 1 << i
    return dict(places)


def edit_distance_to_prefix(item: bytes, text: bytes, most: int) -> tuple[int, int]:
    """(least edit distance of the item to a prefix of the text, that prefix's length), by bit-parallel columns.

    Distances above ``most`` may be reported as any larger number: the score
    falls by one a byte at most, so a column that cannot come down to it ends.
    """
    if text.startswith(item):
        return 0, len(item)
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places = _places(item)
    up, down, score = full, 0, n
    best, best_end = n, 0
    text = text[:n + most]
    slack = most + len(text) - 1
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full      # the first row counts the skipped text
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if score < best:
            best, best_end = score, j + 1
        if score > slack - j:
            break
    return best, best_end


def distances_from(item: bytes, text: bytes, most: int, width: int) -> list[int]:
    """For the first ``width`` places of the text, the least edit distance of the item to a stretch that starts there.

    One bit-parallel search of the item in the text, both from their ends.
    Distances above ``most`` may be reported as any larger number.
    """
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places: dict[int, int] = defaultdict(int)
    for c in set(item):
        places[c] = int(item.translate(bytes(49 if x == c else 48 for x in range(256))), 2)     # bit i: the i-th byte from the end
    out = [most + 1] * width
    up, down, score = full, 0, n
    for j in range(len(text) - 1, -1, -1):
        eq = places.get(text[j], 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if j < width:
            out[j] = score
        if score > most + j:
            break
    return out


def _word_starts(b: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero((b[:-1] == 32) | (b[:-1] == 10)) + 1]) if len(b) else np.empty(0, np.int64)


def _inner_starts(b: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places inside long words at which a stretch may begin: chosen by the bytes there, so a copy has the same."""
    if not len(words) or np.diff(words, append=len(b)).max() <= LONG_WORD:
        return np.empty(0, np.int64)
    at = np.flatnonzero(_gram_hashes(b, 4) >> np.uint32(28) == 0)
    return at[at - words[np.searchsorted(words, at, side="right") - 1] >= LONG_WORD]


def pieces(item: bytes) -> list[tuple[int, bytes]]:
    """(offset, stretch) of the stretches by which an item is looked for; together they make up the item."""
    if len(item) <= STRETCH:
        return [(0, item)]
    b = np.frombuffer(item, np.uint8)
    words = _word_starts(b)
    starts = np.unique(np.concatenate([words, _inner_starts(b, words)]))
    goals = np.arange(0, len(item), len(item) / math.ceil(len(item) / STRETCH))
    above = np.minimum(np.searchsorted(starts, goals), len(starts) - 1)
    below = np.maximum(above - 1, 0)
    nearest = np.where(np.abs(starts[above] - goals) < np.abs(starts[below] - goals), above, below)
    cuts = [int(x) for x in np.unique(starts[nearest])]
    return [(at, item[at:end]) for at, end in zip(cuts, cuts[1:] + [len(item)])]


def _with_edits(text: bytes, edits: int, kind: int, rng: np.random.Generator) -> bytes:
    """The text with random edits: 0 replaced, 1 deleted, 2 inserted, 3 mixed."""
    out = bytearray(text)
    for _ in range(edits):
        k, c, how = int(rng.integers(len(out))), text[rng.integers(len(text))], kind if kind < 3 else int(rng.integers(3))
        out[k:k + (how != 2)] = bytes([c] if how != 1 else [])
    return bytes(out)


class SizeClass:
    """Pieces of similar length: their q-gram bound, sampled steps and keys."""

    def __init__(self, members: range, texts: list[bytes]):
        self.members = members
        lengths = [len(texts[i]) for i in members]
        self.least, self.most = min(lengths), max(lengths)
        edits = allowed_edits(self.most)
        self.q = max(1, min(GRAM, self.least // (edits + 1)))
        self.need = max(1, min(n - self.q + 1 - allowed_edits(n) * self.q for n in lengths))
        self.span = self.most + edits
        # a pointer moves every second step on average, so these steps stay inside the shortest piece
        self.steps = max(1, int(1.6 * self.least))
        self.samples: list[list[np.ndarray]] = []
        self.keys: list[list[tuple[np.ndarray, np.ndarray]]] = []

    def draw(self, tables: int, rng: np.random.Generator) -> None:
        self.samples = [[np.sort(rng.integers(0, self.steps, BITS)) for _ in range(tables)] for _ in range(WALKS)]


def tables_needed(agreement: np.ndarray) -> int:
    """Tables per walk that the recall takes, 0 if MOST_TABLES do not reach it: agreement is (kinds of edits, copies, walks)."""
    missed = np.prod(1 - agreement ** BITS, axis=2)              # by one table of every walk
    for tables in range(1, MOST_TABLES + 1):
        if (missed ** tables).mean(axis=1).max() <= 1 - RECALL:
            return tables
    return 0


def _keys(read: np.ndarray, samples: np.ndarray, salt: int) -> np.ndarray:
    """One hash per row of the bytes read at the sampled steps: read is (steps, rows)."""
    h = np.full(read.shape[1], np.uint64(salt + 1))
    for s in samples:
        h = (h ^ read[s]) * _K
        h ^= h >> np.uint64(32)
    return h


class Searcher:
    """Finds the items of one block in normalised documents; table_counts are those of an equal Searcher, else measured."""

    def __init__(self, items: list[tuple[int, bytes]], seed: int = 11, table_counts: list[int] | None = None):
        by_text: dict[bytes, list[int]] = defaultdict(list)
        for item_id, text in items:
            if text:
                by_text[text].append(item_id)
        self.texts = sorted(by_text, key=lambda t: (len(t), t))
        self.ids = [sorted(by_text[t]) for t in self.texts]
        by_piece: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, text in enumerate(self.texts):
            for offset, piece in pieces(text):
                by_piece[piece].append((i, offset))
        self.pieces = sorted(by_piece, key=lambda t: (len(t), t))
        self.owners = [by_piece[t] for t in self.pieces]         # (item, offset) of each piece
        self.split = len(self.texts) > 0 and len(self.texts[-1]) > STRETCH
        rng = np.random.default_rng(seed)
        self.classes: list[SizeClass] = []
        at = 0
        while at < len(self.pieces):
            end = at
            while end < len(self.pieces) and len(self.pieces[end]) <= len(self.pieces[at]) * CLASS_RATIO:
                end += 1
            self.classes.append(SizeClass(range(at, end), self.pieces))
            at = end
        self.longest = len(self.texts[-1]) + allowed_edits(len(self.texts[-1])) if self.texts else 0
        longest_walk = max((c.steps for c in self.classes), default=0)
        # the random functions of the walks: whether the pointer moves, by step and character
        self.moves = [rng.integers(0, 2, (longest_walk, 256)).astype(np.uint8) for _ in range(WALKS)]
        grams = sum(len(t) for t in self.pieces)
        self.bits = min(30, max(GRAM_TABLE_BITS, (16 * max(1, grams)).bit_length()))
        self.tables: dict[int, np.ndarray] = {}
        for c in self.classes:
            table = self.tables.setdefault(c.q, np.zeros(1 << self.bits, bool))
            for i in c.members:
                table[self._slots(np.frombuffer(self.pieces[i], np.uint8), c.q)] = True
        if table_counts is None:
            trials = np.random.default_rng(seed + 1)
            table_counts = [tables_needed(self._agreement(c, trials)) for c in self.classes]
        self.table_counts = table_counts
        # q-gram -> pieces, for the classes without tables
        self.holders: dict[int, dict[int, np.ndarray]] = {}
        for n, (c, tables) in enumerate(zip(self.classes, table_counts)):
            c.draw(tables, rng)
            if not tables:
                self.holders[n] = self._holders(c)
                continue
            for w in range(WALKS):
                read = self._walk(*self._rows([self.pieces[i] for i in c.members]), w, c.steps)
                c.keys.append([])
                for t, samples in enumerate(c.samples[w]):
                    k = _keys(read, samples, t)
                    order = np.argsort(k, kind="stable")
                    c.keys[w].append((k[order], np.asarray(c.members)[order]))

    @staticmethod
    def _rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The texts one after the other, each followed by zeros to the same width, and their starts."""
        width = max(len(t) for t in texts) + 1
        return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8), np.arange(len(texts)) * width

    def _agreement(self, c: SizeClass, rng: np.random.Generator) -> np.ndarray:
        """Share of steps on which pieces of a class and copies at the edit bound agree: (kinds of edits, copies, walks)."""
        chosen = [self.pieces[int(i)] for i in rng.integers(c.members.start, c.members.stop, TRIALS)]
        after = [self.pieces[int(i)] for i in rng.integers(c.members.start, c.members.stop, TRIALS)]
        whole = self._rows(chosen)
        out = np.empty((4, TRIALS, WALKS))
        for kind in range(4):
            copies = self._rows([_with_edits(t, allowed_edits(len(t)), kind, rng) + b" " + a for t, a in zip(chosen, after)])
            for w in range(WALKS):
                out[kind, :, w] = (self._walk(*whole, w, c.steps) == self._walk(*copies, w, c.steps)).mean(axis=0)
        return out

    def _slots(self, b: np.ndarray, q: int) -> np.ndarray:
        return _gram_hashes(b, q) >> np.uint32(32 - self.bits)

    def _holders(self, c: SizeClass) -> dict[int, np.ndarray]:
        lists: dict[int, list[int]] = defaultdict(list)
        for i in c.members:
            for slot in np.unique(self._slots(np.frombuffer(self.pieces[i], np.uint8), c.q)).tolist():
                lists[slot].append(i)
        return {slot: np.array(members) for slot, members in lists.items()}

    def _sharing(self, n: int, data: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start number, piece number) of the windows that hold as many q-grams of a piece as it keeps after its edits."""
        c, lists = self.classes[n], self.holders[n]
        if not len(rows):
            return
        slots = self._slots(data, c.q)
        least = np.array([max(1, len(t) - c.q + 1 - allowed_edits(len(t)) * c.q) for t in (self.pieces[i] for i in c.members)])
        for r in rows.tolist():
            held = [lists[x] for x in slots[starts[r]:starts[r] + max(1, c.span - c.q + 1)].tolist() if x in lists]
            if held:
                counts = np.bincount(np.concatenate(held) - c.members.start, minlength=len(c.members))
                yield from ((r, c.members.start + int(i)) for i in np.flatnonzero(counts >= least))

    def _walk(self, data: np.ndarray, starts: np.ndarray, walk: int, steps: int) -> np.ndarray:
        """What the pointers from ``starts`` read at each step: (steps, rows)."""
        out, at, moves = np.empty((steps, len(starts)), np.uint8), starts.copy(), self.moves[walk]
        for j in range(steps):
            data.take(at, out=out[j], mode="clip")
            at += moves[j].take(out[j])
        return out

    def _open_windows(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each size class, the numbers of the starts whose windows hold enough q-grams of items."""
        sums = {}
        for q, table in self.tables.items():
            hits = table[self._slots(data, q)]
            sums[q] = np.concatenate([[0], np.cumsum(hits, dtype=np.int32)])
        out = []
        for c in self.classes:
            s = sums[c.q]
            last = len(s) - 1
            lo, hi = np.minimum(starts, last), np.minimum(starts + max(1, c.span - c.q + 1), last)
            out.append(np.flatnonzero(s[hi] - s[lo] >= c.need))
        return out

    def candidates(self, data: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(start number, piece number) of windows that share a key with a piece."""
        found: set[tuple[int, int]] = set()
        open_ = self._open_windows(data, starts)
        for n in self.holders:
            found.update(self._sharing(n, data, starts, open_[n]))
        open_ = [np.empty(0, np.int64) if n in self.holders else o for n, o in enumerate(open_)]
        some = np.unique(np.concatenate(open_)) if open_ else np.empty(0, np.int64)
        padded = np.concatenate([data, np.zeros(130, np.uint8)])
        for first in range(0, len(some), 4096):              # bounds the memory of the walks
            part = some[first:first + 4096]
            inside = [(c, np.flatnonzero(np.isin(part, o, assume_unique=True))) for c, o in zip(self.classes, open_)]
            steps = max((c.steps for c, rows in inside if len(rows)), default=0)
            for w in range(WALKS):
                read = self._walk(padded, starts[part], w, steps)
                for c, rows in inside:
                    if not len(rows):
                        continue
                    mine = read[:c.steps, rows]
                    for t, samples in enumerate(c.samples[w]):
                        keys, members = c.keys[w][t]
                        k = _keys(mine, samples, t)
                        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
                        for r in np.flatnonzero(hi > lo):
                            found.update((int(part[rows[r]]), int(m)) for m in members[lo[r]:hi[r]])
        return found

    @staticmethod
    def _long_places(item: bytes, section: bytes, offsets: list[int], words: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, distance, bytes) of a longer item near the offsets, at the words given; overlapping ones are one."""
        most, out = allowed_edits(len(item)), []
        ranges: list[list[int]] = []
        for at in offsets:
            if ranges and at - most <= ranges[-1][1]:
                ranges[-1][1] = at + most
            else:
                ranges.append([at - most, at + most])
        for lo, hi in ranges:
            near = [int(x) for x in words[np.searchsorted(words, lo):np.searchsorted(words, hi, side="right")]]
            if not near:
                continue
            exact = next((x for x in near if section.startswith(item, x)), None)
            if exact is not None and exact - len(item) + most < lo and hi < exact + len(item):     # all others overlap it
                out.append((exact, 0, len(item)))
                continue
            first, width = near[0], near[-1] - near[0] + 1
            least = distances_from(item, section[first:first + width + len(item) + most], most, width)
            taken: list[tuple[int, int, int]] = []
            for distance, x in sorted((least[x - first], x) for x in near if least[x - first] <= most):
                # a stretch has between len(item) - distance and len(item) + distance bytes
                if any(s < x + len(item) - distance and x < s + size for s, _, size in taken):
                    continue
                size = edit_distance_to_prefix(item, section[x:x + len(item) + most], most)[1]
                if not any(s < x + size and x < s + n for s, _, n in taken):
                    taken.append((x, distance, size))
            out += taken
        return out

    def search(self, docs: list[bytes]) -> list[list[tuple[int, int, int, int, int]]]:
        """For each document, (item_id, distance, first word, bytes, places) of every item it leaks."""
        out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in docs]
        if not self.classes:
            return out
        places: list[dict[int, list[tuple[int, int, int]]]] = [defaultdict(list) for _ in docs]
        group: list[tuple[int, int]] = []                     # (document, start of the section)
        parts, held = [], 0

        def flush() -> None:
            joined = b"\n".join(p for p, _ in parts)
            data = np.frombuffer(joined, np.uint8)
            begin = np.cumsum([0] + [len(p) + 1 for p, _ in parts])[:-1]
            words = _word_starts(data)
            starts = np.unique(np.concatenate([words, _inner_starts(data, words)])) if self.split else words
            owner = np.searchsorted(begin, starts, side="right") - 1
            owned = starts - begin[owner] < np.array([own for _, own in parts])[owner]
            if not self.split:                                # else an item may begin before the end of what is owned
                starts, owner, owned = starts[owned], owner[owned], owned[owned]
            at_word = np.isin(starts, words, assume_unique=True)
            begins: dict[tuple[int, int], set[int]] = defaultdict(set)
            for s, piece in self.candidates(data, starts):
                o = int(owner[s])
                doc, base = group[o]
                offset = int(starts[s] - begin[o])
                text, section = self.pieces[piece], parts[o][0]
                most = allowed_edits(len(text))
                whole = len(self.texts[self.owners[piece][0][0]]) == len(text)
                near = most if whole and len(self.owners[piece]) == 1 else 2 * most
                distance, size = edit_distance_to_prefix(text, section[offset:offset + len(text) + near], near)
                for item, shift in self.owners[piece] if distance <= near else ():
                    if len(self.texts[item]) > len(text):
                        begins[o, item].add(offset - shift)
                    elif distance <= most and owned[s] and at_word[s]:
                        places[doc][item].append((base + offset, distance, size))
            for (o, item), offsets in begins.items():
                doc, base = group[o]
                lo, hi = np.searchsorted(words, begin[o]), np.searchsorted(words, begin[o] + parts[o][1])
                for at, distance, size in self._long_places(
                        self.texts[item], parts[o][0], sorted(offsets), words[lo:hi] - begin[o]):
                    places[doc][item].append((base + at, distance, size))

        for d, text in enumerate(docs):
            for at in range(0, max(1, len(text)), SECTION):
                if text:
                    group.append((d, at))
                    # a section owns the windows that start in it and sees their ends
                    parts.append((text[at:at + SECTION + self.longest], min(SECTION, len(text) - at)))
                    held += len(parts[-1][0])
                if held >= GROUP:
                    flush()
                    group, parts, held = [], [], 0
        if parts:
            flush()
        for d, text in enumerate(docs):
            for item, found in places[d].items():
                found.sort()
                n, reach = 0, -1
                for at, _, size in found:                     # overlapping stretches are one place
                    if at >= reach:
                        n += 1
                    reach = max(reach, at + size)
                at, distance, size = min(found, key=lambda x: (x[1], x[0]))
                out[d] += [(i, distance, text.count(b" ", 0, at), size, n) for i in self.ids[item]]
            out[d].sort()
        return out


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most BLOCK_BYTES (a longer item is a block of its own)."""
    block, held = [], 0
    rows = benchmark.select(item_id, text).where(F.col(text).isNotNull()).orderBy(item_id, text)
    for row in rows.toLocalIterator():
        t = normalised(row[1])
        if block and held + len(t) > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((row[0], t))
        held += len(t)
    if block:
        yield block


MATCH_SCHEMA = "doc_id long, item_id long, distance int, word long, n_bytes long, places int"


_SEARCHERS: dict[str, Searcher] = {}


def _searcher(name: str, block: list[tuple[int, bytes]], counts: list[int]) -> Searcher:
    """The index of a block, built once per worker; the longest unused one goes first."""
    search = _SEARCHERS.pop(name, None) or Searcher(block, table_counts=counts)
    while len(_SEARCHERS) >= KEPT_SEARCHERS:
        _SEARCHERS.pop(next(iter(_SEARCHERS)))
    _SEARCHERS[name] = search
    return search


def _search_task(block: list[tuple[int, bytes]]):
    counts, name = Searcher(block).table_counts, uuid.uuid4().hex           # measured once, not by every task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searcher(name, block, counts)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = search.search([normalised(t) for t in part.column(1).to_pylist()])
                rows = [(d, *f) for d, fs in zip(part.column(0).to_pylist(), found) for f in fs]
                if rows:
                    c = list(zip(*rows))
                    yield pa.record_batch(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()),
                         pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64()), pa.array(c[5], pa.int32())],
                        names=["doc_id", "item_id", "distance", "word", "n_bytes", "places"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it leaks: doc_id, item_id, distance, word, n_bytes, places."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in item_blocks(benchmark):
        part = rows.mapInArrow(_search_task(block), MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], MATCH_SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; judged row by row, so NULL or repeated ids don't matter."""
    at = docs.columns.index(text)
    for block in item_blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], block=block, name=uuid.uuid4().hex,
                counts=Searcher(block).table_counts) -> Iterator[pa.RecordBatch]:
            search = _searcher(name, block, counts)
            for batch in batches:
                for i in range(0, batch.num_rows, 512):
                    part = batch.slice(i, 512)
                    found = search.search([normalised(t) for t in part.column(at).to_pylist()])
                    yield part.filter(pa.array([not f for f in found], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
