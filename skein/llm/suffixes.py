"""Removal of repeated 400-byte strings: a sparse suffix array over content-chosen anchors, sorted deep-shallow.

Every window of LENGTH bytes has one anchor: of its first WINDOW positions the one whose GRAM bytes
hash lowest (the leftmost of equals). Equal windows have their anchors at the same offset and share
the CONTEXT bytes from there, so windows repeat only within groups of anchors with equal context,
about one anchor for each 100 bytes. Inside a group the suffixes that start at the anchors are
sorted by multikey quicksort to a shallow depth and by blind tries below it; the texts before the
anchors likewise, read backwards. The two orders give for each anchor the windows that some other
anchor shares.

Beside the bytes, passages of PASSAGE words that stand in several rows are marked, whatever white
space is between their words. Their anchors are chosen among words the same way, and what whole
surroundings don't settle is compared through 128-bit digests of the windows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import map_arrow, written

GRAM = 32
#: Groups with more anchors than this are settled by window digests instead of in one task: about 100 MB of texts.
HOT = 100_000
SHALLOW = 32
#: Bytes, or words, that are hashed at once; anchors that are combined before they are sent.
SEGMENT, CHUNK = 1 << 19, 1 << 18
#: Low bits of a sort key that hold a position; the same for all texts, so that equal windows choose equal anchors.
BITS = 24
#: Words of a passage, and of the context at its anchor.
PASSAGE, PASSAGE_CONTEXT = 50, 16
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True

_rng = np.random.default_rng(20240229)
_BYTE = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1 for _ in range(2)]
_BASE = [0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        inverse = pow(_BASE[which], -1, 1 << 64)
        both = []
        for b in (_BASE[which], inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _powers[which] = (both[0], both[1])
    return have


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of all substrings of a sequence, of bytes or of 64-bit word codes, from prefix sums."""

    def __init__(self, letters: np.ndarray, which: int = 0):
        n = len(letters)
        up, down = _power(n + 1, which)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE[which][letters] if letters.dtype == np.uint8 else letters) * up[:n], out=self.sums[1:])
        self.down = down

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64) * np.uint64(0x94D049BB133111EB))


def word_codes(raw: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, 64-bit code) of each word; long texts are cut between words, so memory beyond the result is bounded."""
    starts, codes, at, n = [], [], 0, len(raw)
    while at < n:
        size = segment
        while True:  # a word longer than a segment widens it
            part = raw[at : at + size]
            space = _SPACE[part]
            if at + size >= n:
                break
            last = np.flatnonzero(space)
            if len(last):
                part, space = part[: last[-1] + 1], space[: last[-1] + 1]
                break
            size *= 2
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        first, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        starts.append(first + at)
        codes.append(Hashes(part).of(first, stop))
        at += len(part)
    return (np.concatenate(starts), np.concatenate(codes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


@dataclass(frozen=True)
class Windows:
    """Windows of `length` letters: their anchors, each followed by a context of `context` letters."""

    length: int
    context: int
    gram: int
    kind: int = 0

    @property
    def reach(self) -> int:
        return self.length - self.context + 1

    def anchors(self, letters: np.ndarray, begin: np.ndarray, end: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, ...] | None:
        """(row, position, least and most offset of its windows, context hash, surroundings digest) for each anchor.

        Row i is letters[begin[i]:end[i]]; rows don't overlap. Rows are hashed together; those
        longer than a segment are taken in segments of windows, so memory is bounded by it.
        """
        if int((end - begin).max(initial=0)) <= segment:
            part = self._some(letters, begin, end, begin, end)
            return None if part is None else self._finish(letters, begin, end, *part)
        rows = []
        for i, (a, z) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
            for first in range(a, z - self.length + 1, segment):
                last = min(first + segment, z - self.length + 1)  # windows [first, last)
                base, stop = first, min(z, last + self.length - 1)
                part = self._some(letters[base:stop], *(np.array([x]) for x in (0, stop - base, 0, stop - base)))
                rows.append([np.full(len(part[0]), i), part[1] + base, *part[2:]])
                if len(rows) > 1 and rows[-2][0][-1] == i and rows[-2][1][-1] == rows[-1][1][0]:  # the anchor goes on
                    rows[-2][2][-1] = rows[-1][2][0]
                    rows[-1] = [x[1:] for x in rows[-1]]
                    if not len(rows[-1][0]):
                        rows.pop()
        return self._finish(letters, begin, end, *(np.concatenate(x) for x in zip(*rows, strict=True))) if rows else None

    def _some(self, letters: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...] | None:
        many = np.maximum(last - first - self.length + 1, 0)
        total = int(many.sum())
        if not total:
            return None
        row = np.repeat(np.arange(len(begin)), many)
        window = np.arange(total) + np.repeat(first - (np.cumsum(many) - many), many)
        hashes = Hashes(letters)
        at = np.arange(len(letters) - self.context + 1)
        if len(at) >> BITS:
            raise ValueError("segments and windows must stay below 2**24 letters together")
        bits = np.uint64(BITS)
        # the low bits hold the position: the least key is the leftmost of the lowest hashes
        key = ((hashes.of(at, at + min(self.gram, self.context)) >> bits) << bits) | at.astype(np.uint64)
        size = 1
        while size * 2 <= self.reach:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < self.reach:
            key = np.minimum(key[: len(key) - (self.reach - size)], key[self.reach - size :])
        chosen = (key[window] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])])
        stop = np.r_[new[1:], total] - 1
        pos = chosen[new]
        return row[new], pos, pos - window[stop], pos - window[new], hashes.of(pos, pos + self.context)

    def _finish(self, letters: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, pos: np.ndarray, dmin: np.ndarray, dmax: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        left, right = np.maximum(pos - (self.reach - 1), begin[row]), np.minimum(pos + self.length, end[row])
        view, unit, digest = memoryview(np.ascontiguousarray(letters)).cast("B"), letters.itemsize, xxhash.xxh3_64_intdigest
        around = np.fromiter((digest(view[a:z], d) for a, z, d in zip((unit * left).tolist(), (unit * right).tolist(), (pos - left).tolist(), strict=True)), np.uint64, len(pos))
        return row, pos - begin[row], dmin, dmax, (h & ~np.uint64(1)) | np.uint64(self.kind), around


def byte_windows(length: int) -> Windows:
    return Windows(length, length // 2 + 1, GRAM)


def word_windows(words: int) -> Windows:
    return Windows(words, min(PASSAGE_CONTEXT, words), PASSAGE_CONTEXT, 1)


# --- deep-shallow sorting


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, of which `known` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """A trie that keeps branching depths and bytes only; the strings decide where a new one goes."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth = strings, depth
        self.root: list | None = None  # a leaf is ["", ids]; a node is [depth, {byte: child}]

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [-1, [i]]
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            node = child if child is not None else next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        shared = common(s, other, self.depth)
        if shared == len(s) == len(other):
            node[1].append(i)
            return
        parent, edge, node = None, None, self.root
        while 0 <= node[0] < shared:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        mine = s[shared] if shared < len(s) else -1
        if node[0] == shared:
            node[1][mine] = [-1, [i]]
            return
        split = [shared, {mine: [-1, [i]], (other[shared] if shared < len(other) else -1): node}]
        if parent is None:
            self.root = split
        else:
            parent[1][edge] = split

    def in_order(self) -> Iterator[tuple[int, int]]:
        """(string, bytes it shares with the one before it) in sorted order."""
        stack: list[tuple[list, int]] = [(self.root, self.depth)]
        while stack:
            node, shared = stack.pop()
            if node[0] < 0:
                for k, i in enumerate(node[1]):
                    yield i, shared if k == 0 else len(self.strings[i])
            else:
                children = [node[1][b] for b in sorted(node[1])]
                stack += [(c, node[0]) for c in reversed(children[1:])]
                stack.append((children[0], shared))


def deep_shallow_sort(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Sorted order of strings that share `depth` bytes, and the common prefix of each with the one before it (first: 0).

    Multikey quicksort compares eight bytes at a time down to `shallow` bytes beyond depth; groups
    that still agree go to blind tries.
    """
    order: list[int] = []
    shared: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), depth)]
    while stack:
        ids, at = stack.pop()
        if len(ids) == 1:
            order.append(ids[0])
            shared.append(-1)
        elif at >= depth + shallow:
            trie = BlindTrie(strings, at)
            for i in ids:
                trie.insert(i)
            for k, (i, n) in enumerate(trie.in_order()):
                order.append(i)
                shared.append(n if k else -1)
        else:
            words = {i: strings[i][at : at + 8] for i in ids}
            pivot = sorted((words[ids[0]], words[ids[len(ids) // 2]], words[ids[-1]]))[1]
            less, same, more = [], [], []
            for i in ids:
                (same if words[i] == pivot else less if words[i] < pivot else more).append(i)
            if len(pivot) < 8:  # these strings end here, and are equal
                stack += [(more, at)] if more else []
                stack += [([i], at) for i in reversed(same)]
            else:
                stack += [(more, at)] if more else []
                stack += [(same, at + 8)] if same else []
            stack += [(less, at)] if less else []
    for k, n in enumerate(shared):
        if n < 0:
            shared[k] = common(strings[order[k - 1]], strings[order[k]], depth) if k else 0
    return order, shared


def shared_windows(lefts: list[bytes], rights: list[bytes], length: int, depth: int) -> list[list[tuple[int, int]]]:
    """For each anchor the ranges (least, most offset) of windows that another anchor of the group shares.

    lefts are read backwards from the anchors; rights start at them and share `depth` bytes. Anchors
    are joined by falling common left text; each joined set is kept in the order of the right texts,
    where the best partner is always a neighbour, and the smaller set goes into the larger.
    """
    n = len(lefts)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]

    def meet(x: int, y: int, left: int) -> None:
        low = max(0, length - common(rights[x], rights[y], depth))
        if low <= left:
            out[x].append((low, left))
            out[y].append((low, left))

    if n == 2:
        meet(0, 1, common(lefts[0], lefts[1]))
        return out
    by_right, _ = deep_shallow_sort(rights, depth)
    rank = [0] * n
    for r, i in enumerate(by_right):
        rank[i] = r
    by_left, shared = deep_shallow_sort(lefts)
    sets: list[list[int]] = [[rank[i]] for i in by_left]
    owner = list(range(n))

    def find(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    for k in sorted(range(1, n), key=lambda k: -shared[k]):
        a, b = find(k - 1), find(k)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        big = sets[a]
        for r in sets[b]:
            p = bisect_left(big, r)
            if p:
                meet(by_right[big[p - 1]], by_right[r], shared[k])
            if p < len(big):
                meet(by_right[big[p]], by_right[r], shared[k])
            big.insert(p, r)
        sets[b] = []
        owner[b] = a
    return out


# --- the distributed part

_SPANS = "doc long, key long, lo int, hi int, kind int"
_ANCHORS = "h long, around long, doc long, key long, pos int, dmin int, dmax int, state int"
_SETTLED = f"{_ANCHORS}, hot boolean"
_PARTS = "tag int, h long, w long, doc long, key long, pos int, dmin int, dmax int, state int, before binary, after binary"
#: What an anchor or a digest is known to be: alone so far, the one of several that goes on, or settled and only a span. Asked anchors that are spans too have ALSO added.
OPEN, SEVERAL, DONE, ALSO = 0, 1, 2, 4


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, key, doc_id, raw): doc and key name a row; only rows that are wholly alike share them."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("raw"))
    return rows.select(F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.xxhash64("raw", F.col("doc_id").isNull()).alias("key"), "doc_id", F.col("raw").cast("binary").alias("raw"))


def _batch(cols: Iterable[np.ndarray | list], schema: str) -> pa.RecordBatch:
    kinds = {"long": (pa.int64(), np.int64), "int": (pa.int32(), np.int32), "boolean": (pa.bool_(), bool)}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    out = []
    for c, t in zip(cols, types, strict=True):
        if t == "binary":
            out.append(pa.array(c, pa.binary()))
        else:
            c = np.ascontiguousarray(c)
            out.append(pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(kinds[t][1]), kinds[t][0]))
    return pa.RecordBatch.from_arrays(out, list(names))


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run of each row, first row of each run) from the rows where one begins."""
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _several(kind: np.ndarray, run: np.ndarray, first: np.ndarray, doc: np.ndarray, key: np.ndarray, state: np.ndarray) -> np.ndarray:
    """For each run of equal rows, sorted by doc and key: does it stand in several places (kind 0) or several rows (kind 1)?"""
    size = np.bincount(run)
    last = first + size - 1
    known = np.bincount(run, weights=state == SEVERAL) > 0
    return known | np.where(kind[first] == 0, size > 1, (doc[first] != doc[last]) | (key[first] != key[last]))


def combined(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (a, b, doc, key, ..., state) with those that settle each other here marked; one goes on for each equal (a, b) of them.

    It keeps what many rows share from growing with them in the shuffle: the kind is the low bit of a.
    """
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    cols = [c[order] for c in cols]
    a, b, doc, key, state = cols[0], cols[1], cols[2], cols[3], cols[-1]
    run, first = _runs(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    many = _several(a & a.dtype.type(1), run, first, doc, key, state)
    state = np.where(many[run], DONE, OPEN)
    state[first[many]] = SEVERAL
    return [*cols[:-1], state]


def _find_anchors(windows: list[Windows], segment: int = SEGMENT, chunk: int = CHUNK):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for doc, key, raws in _by_bytes(batches, segment):
            # a line feed between rows ends their last words
            data = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
            ends = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws))) - 1
            begins = np.r_[0, ends[:-1] + 1]
            for w in windows:
                if w.kind:
                    starts, letters = word_codes(data)
                    edges = np.searchsorted(starts, np.r_[begins, len(data)])
                    found = w.anchors(letters, edges[:-1], edges[1:], segment)
                else:
                    found = w.anchors(data, begins, ends, segment)
                if found is not None:
                    row, pos, dmin, dmax, h, around = found
                    held.append([h, around, doc[row], key[row], pos, dmin, dmax, np.zeros(len(row), np.int64)])
                    size += len(row)
            if size >= chunk:
                yield _batch(combined([np.concatenate(x) for x in zip(*held, strict=True)]), _ANCHORS)
                held, size = [], 0
        if size:
            yield _batch(combined([np.concatenate(x) for x in zip(*held, strict=True)]), _ANCHORS)

    return run


def _by_bytes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[memoryview]]]:
    """(doc, key, texts) of some rows together, of about `size` bytes; a longer text comes alone."""
    for b in batches:
        doc, key = (b.column(i).to_numpy() for i in (0, 1))
        at = total = 0
        for i, n in enumerate(pc.binary_length(b.column(2)).to_pylist()):
            if i > at and total + n > size:
                yield doc[at:i], key[at:i], [x.as_buffer() for x in b.column(2)[at:i]]
                at, total = i, 0
            total += n
        if at < b.num_rows:
            yield doc[at:], key[at:], [x.as_buffer() for x in b.column(2)[at:]]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, around, doc, key): equal surroundings settle each other; different ones in a group ask for their texts.

    A group of at most HOT rows, or the rows of one surroundings in a hot one, are looked at together;
    copies have been combined before, so there is one row for each chunk that holds some.
    """

    def work(c: list[np.ndarray]) -> pa.RecordBatch | None:
        h, around, doc, key, pos, dmin, dmax, state, hot = c
        kind = h & 1
        new_h = np.r_[True, h[1:] != h[:-1]]
        group, head = _runs(new_h)
        run, first = _runs(new_h | np.r_[True, around[1:] != around[:-1]])
        many = _several(kind, run, first, doc, key, state)
        done = many[run]
        # of the words several rows must have some in the group, for bytes several surroundings do
        mixed = np.bincount(group, weights=np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | new_h[1:]]) > 1
        mixed |= np.bincount(group, weights=state == SEVERAL) > 0
        runs = np.bincount(group[first]) > 1
        worth = (runs & (mixed | (kind[head] == 0)))[group] | (hot > 0)
        lead = np.zeros(len(h), bool)
        lead[first] = True
        # all rows that aren't settled ask, and one of each surroundings that is
        ask = worth & (lead | ~done)
        keep = done | ask
        if not keep.any():
            return None
        known = np.where(ask, np.where(done, SEVERAL | ALSO, OPEN), DONE)
        return _batch([*(x[keep] for x in (h, around, doc, key, pos, dmin, dmax, known)), hot[keep] > 0], _SETTLED)

    held: list[list[np.ndarray]] = []
    size, goal = 0, 1 << 17
    for b in batches:
        rows = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in b.columns]
        lone = rows[7] == DONE
        if lone.any():
            yield _batch([*(x[lone] for x in rows[:8]), rows[8][lone] > 0], _SETTLED)
            rows = [x[~lone] for x in rows]
        if not len(rows[0]):
            continue
        held.append(rows)
        size += len(rows[0])
        if size >= goal:
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            # a hot group is spread by its surroundings; others end where h ends
            ends = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | ((cols[8][1:] > 0) & (cols[1][1:] != cols[1][:-1])))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut and (out := work([x[:cut] for x in cols])) is not None:
                yield out
            held, size = [[x[cut:] for x in cols]], len(cols[0]) - cut
            goal = max(1 << 17, 2 * size)
    if size and (out := work([np.concatenate(x) for x in zip(*held, strict=True)])) is not None:
        yield out


def _cut(length: int, words: int, chunk: int = CHUNK):  # noqa: ANN202
    """What asked anchors are compared by: the texts around those of bytes (tag 0); digests of the windows of hot ones (tag 2) and of words (tag 3)."""
    half = length - length // 2 - 1

    def contexts(rows: list[tuple]) -> pa.RecordBatch:
        h, doc, key, pos, dmin, dmax, state, before, after = zip(*rows, strict=True)
        none = [0] * len(h)
        return _batch([none, h, none, doc, key, pos, dmin, dmax, state, before, after], _PARTS)

    def digests(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        w1, w2, doc, key, pos, state = combined([np.concatenate(x) for x in zip(*held, strict=True)])
        tag, more = 2 + (w1 & np.uint64(1)).astype(np.int64), np.zeros(len(w1), np.int64)
        # settled windows side by side are one span
        done = np.flatnonzero(state == DONE)
        done = done[np.lexsort((pos[done], key[done], doc[done], tag[done]))]
        step = [tag[done], doc[done], key[done], pos[done] - np.arange(len(done))]
        head = np.flatnonzero(np.any([np.r_[True, x[1:] != x[:-1]] for x in step], axis=0)) if len(done) else done
        more[done[head]] = np.diff(np.r_[head, len(done)]) - 1
        keep = np.r_[np.flatnonzero(state != DONE), done[head]]
        cols = [x[keep] for x in (tag, w1, w2, doc, key, pos, more, more, state)]
        return _batch([*cols, *[[None] * len(keep)] * 2], _PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for b in batches:
            out: list[tuple] = []
            out_bytes = 0
            for doc, key, raw, asked in zip(*(b.column(i) for i in range(4)), strict=True):
                data = raw.as_buffer()
                d, k = doc.as_py(), key.as_py()
                parts: dict[tuple[int, int], list[np.ndarray]] = {}
                for a in asked.as_py():
                    p, state = a["pos"], SEVERAL if a["state"] & 3 == SEVERAL else OPEN
                    if a["h"] & 1 == 0 and not a["hot"]:
                        out.append((a["h"], d, k, p, a["dmin"], a["dmax"], state, bytes(data[max(0, p - half) : p])[::-1], bytes(data[p : p + length])))
                        out_bytes += length + half
                    else:
                        parts.setdefault((a["h"] & 1, state), []).append(np.arange(p - a["dmax"], p - a["dmin"] + 1))
                for (kind, state), starts in sorted(parts.items()):
                    letters = word_codes(np.frombuffer(data, np.uint8))[1] if kind else np.frombuffer(data, np.uint8)
                    start = np.unique(np.concatenate(starts))
                    n, unit, size_of = len(start), letters.itemsize, words if kind else length
                    view = memoryview(np.ascontiguousarray(letters)).cast("B")
                    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[unit * s : unit * (s + size_of)]) for s in start.tolist()]), ">u8").astype(np.uint64).reshape(-1, 2)
                    held.append([(both[:, 0] & ~np.uint64(1)) | np.uint64(kind), both[:, 1], np.full(n, d), np.full(n, k), start, np.full(n, state)])
                    size += n
                if out_bytes >= 1 << 22:
                    yield contexts(out)
                    out, out_bytes = [], 0
                if size >= chunk:
                    yield digests(held)
                    held, size = [], 0
            if out:
                yield contexts(out)
        if size:
            yield digests(held)

    return run


def _compare(length: int, words: int):  # noqa: ANN202
    """Spans from rows sorted by (tag, h, w, doc, key, pos): groups of texts are sorted, equal digests settle each other."""

    def spans(group: list[tuple]) -> Iterator[tuple]:
        first = {}
        for g in group:
            first.setdefault((g[9], g[10]), g)
        own = list(first.values())  # the same text may have been cut twice from wholly equal rows
        if len(own) < 2:
            return
        depth = length // 2 + 1
        head = own[0][10][:depth]
        depth = depth if all(g[10][:depth] == head for g in own) else 0  # a hash may deceive
        for g, ranges in zip(own, shared_windows([g[9] for g in own], [g[10] for g in own], length, depth), strict=True):
            for low, high in ranges:
                a, z = max(low, g[6]), min(high, g[7])
                if a <= z:
                    yield g[3], g[4], g[5] - z, g[5] - a + length, 0

    def digest_spans(c: list[np.ndarray]) -> pa.RecordBatch | None:
        tag, w1, w2, doc, key, pos, more, state = c
        run, first = _runs(np.r_[True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (tag[1:] != tag[:-1])])
        shown = _several(tag - 2, run, first, doc, key, state)[run] | (state == DONE)
        if not shown.any():
            return None
        tag, doc, key, pos, more = (x[shown] for x in (tag, doc, key, pos, more))
        return _batch([doc, key, pos, pos + more + np.where(tag == 3, words, length), tag - 2], _SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        held: list[list[np.ndarray]] = []
        size, goal = 0, 1 << 17
        for b in batches:
            out: list[tuple] = []
            digests = int(np.count_nonzero(b.column(0).to_numpy()))  # the last rows of a batch
            for row in zip(*(c.to_pylist() for c in b.slice(0, b.num_rows - digests).columns), strict=True):
                if group and group[-1][1] != row[1]:
                    out += spans(group)
                    group = []
                group.append(row)
            if digests:
                out += spans(group)
                group = []
            if out:
                yield _batch(zip(*out, strict=True), _SPANS)
            if not digests:
                continue
            held.append([b.column(i).to_numpy()[b.num_rows - digests :].astype(np.int64) for i in (0, 1, 2, 3, 4, 5, 7, 8)])
            size += digests
            if size >= goal:  # equal digests may go on; copies have been combined, so there is a row for each chunk at most
                c = [np.concatenate(x) for x in zip(*held, strict=True)]
                ends = np.flatnonzero((c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1]))
                cut = int(ends[-1]) + 1 if len(ends) else 0
                if cut and (found := digest_spans([x[:cut] for x in c])) is not None:
                    yield found
                held, size = [[x[cut:] for x in c]], len(c[0]) - cut
                goal = max(1 << 17, 2 * size)
        if group and (out := list(spans(group))):
            yield _batch(zip(*out, strict=True), _SPANS)
        if size and (found := digest_spans([np.concatenate(x) for x in zip(*held, strict=True)])) is not None:
            yield found

    return run


def _spread(rows: DataFrame) -> DataFrame:
    """Rows by their names. Plans that use this twice share one exchange of the texts."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc", "key")


def repeated_spans(rows: DataFrame, length: int = 400, hot: int = HOT, passage: int = PASSAGE) -> DataFrame:
    """(doc, key, lo, hi, kind) for rows named by _keyed: what strings of `length` bytes that start elsewhere too cover, in bytes (kind 0).

    Kind 1: what passages of `passage` words that another row has too cover, in words. Ranges may overlap and repeat.

    Anchors (about one for each length / 4 bytes and one for each 18 words) that agree in their whole
    surroundings are combined before the shuffle, then shuffled by context hash and settled; only one text
    of each different surroundings is then fetched and compared. Context and surroundings are compared by 64-bit
    hashes each, 128 bits together; texts of different surroundings byte by byte. Groups of more than `hot`
    anchors never meet in a task: they are spread by their surroundings, and what is left of them is
    compared through 128-bit digests of its windows. Both ways give the same ranges. Which groups are hot is
    estimated beforehand from one row in `hot` / 1000, as range partitioning samples its keys; it only decides where rows go.
    """
    windows = [byte_windows(length), *([word_windows(passage)] if passage else [])]
    long_rows = rows.where(F.octet_length("raw") >= min(length, 2 * passage - 1 if passage else length)).select("doc", "key", "raw")
    found = map_arrow(long_rows, _find_anchors(windows), _ANCHORS, "suffixes")
    every = max(1, min(64, hot // 1000))
    some = map_arrow(long_rows.where(F.pmod(F.xxhash64("doc", "key"), F.lit(every)) == 0), _find_anchors(windows), _ANCHORS, "suffixes")
    heavy = written(some.where(F.col("state") != DONE).groupBy("h").count().where(F.col("count") > hot // every).select("h", F.lit(1).cast("long").alias("hot")), "anchors-hot")
    any_hot = not heavy.isEmpty()
    # spans that are settled already need no place: they go anywhere
    away = F.when(F.col("state") == DONE, F.xxhash64("doc", "key", "pos")).otherwise(F.col("h"))
    if any_hot:
        marked = found.join(heavy, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(0).cast("long")))
        spread = marked.select("h", "around", "doc", "key", "pos", "dmin", "dmax", "state", "hot").repartition(away, F.when(F.col("hot") > 0, F.col("around")))
    else:
        spread = found.withColumn("hot", F.lit(0).cast("long")).repartition(away)
    settled = written(map_arrow(spread.sortWithinPartitions("h", "around", "doc", "key", "pos"), _settle, _SETTLED, "suffixes"), "settled")
    kind, size = F.col("h").bitwiseAND(F.lit(1)).cast("int"), F.when(F.col("h").bitwiseAND(F.lit(1)) == 0, length).otherwise(passage)
    spans = settled.where("state >= 2").select("doc", "key", (F.col("pos") - F.col("dmax")).alias("lo"), (F.col("pos") - F.col("dmin") + size).alias("hi"), kind.alias("kind"))
    asked = settled.where("state <> 2").groupBy("doc", "key").agg(F.collect_list(F.struct("h", "pos", "dmin", "dmax", "state", "hot")).alias("asked"))
    # doc_id goes along unused: with the same columns the exchange is the one that remove_repeats reads
    joined = _spread(rows).join(asked, ["doc", "key"]).select("doc", "key", "raw", "asked", "doc_id")
    parts = map_arrow(joined, _cut(length, passage), _PARTS, "suffixes")
    away = F.when(F.col("state") == DONE, F.xxhash64("doc", "key", "pos")).otherwise(F.xxhash64("h", "w"))
    compared = map_arrow(parts.repartition(away).sortWithinPartitions("tag", "h", "w", "doc", "key", "pos"), _compare(length, passage), _SPANS, "suffixes")
    return spans.unionByName(compared)


def merge_ranges(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the ranges cover."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, z) for a, z in out]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, hot: int = HOT, passage: int = PASSAGE) -> DataFrame:
    """One row for each input row: (doc_id long, n_bytes, n_removed, n_spans long, kept binary, n_passage_words long).

    Each byte covered by a string of `length` bytes that also starts anywhere else, in another row
    or the same, goes; strings are judged on the input, and matches never cross rows. n_passage_words
    counts the words covered by passages of `passage` words (0: not looked for) that another row holds
    too; they stay in the text unless they are long enough in bytes. Null texts are empty; texts
    shorter than `length` stay whole; repeated rows are repeats of each other in bytes, and one row
    for passages; null ids are kept; extra columns are ignored; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, counts, kept, said = [], [], [], [], []
            edge = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(b.column(2)), 0).to_numpy(zero_copy_only=False))]
            flat = b.column(2).flatten()
            lo, hi, kinds = (x.to_numpy() for x in flat.flatten())
            for raw, a, z in zip(b.column(1), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                data = raw.as_buffer().to_pybytes()
                first, last, words_of = lo[a:z], hi[a:z], kinds[a:z] == 1
                runs, words = (merge_ranges(zip(first[k].tolist(), last[k].tolist(), strict=True)) for k in (~words_of, words_of)) if z > a else ([], [])
                ends = [0, *(x for r in runs for x in r), len(data)]
                kept.append(b"".join(data[a:z] for a, z in zip(ends[::2], ends[1::2], strict=True)))
                sizes.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                counts.append(len(runs))
                said.append(sum(z - a for a, z in words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)), pa.array(kept, pa.binary()), pa.array(said, pa.int64())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_passage_words"]
            )

    keyed = _keyed(docs, doc_id, text)
    # a set: wholly equal rows find the same ranges, which meet before the shuffle
    spans = repeated_spans(keyed, length, hot, passage).groupBy("doc", "key").agg(F.collect_set(F.struct("lo", "hi", "kind")).alias("spans"))
    rows = _spread(keyed).join(spans, ["doc", "key"], "left")
    return map_arrow(rows.select("doc_id", "raw", "spans", "doc", "key"), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_passage_words long", "suffixes")
