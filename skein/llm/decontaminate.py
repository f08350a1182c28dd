"""Benchmark decontamination: pigeonhole pieces found exactly, matches verified by bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import arrow_column, map_arrow

#: Share of a test item's characters that may differ, and items' characters held at once.
ERROR_RATE, BLOCK_CHARS = 0.08, 4_000_000


def normalise(text: str) -> str:
    """Lower case, white space runs as one space."""
    return " ".join(text.lower().split())


class Myers:
    """Edit distance of a pattern to the nearest substring of a text (Myers 1999, Hyyrö's form)."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end): the least distance of any substring and the first place where one ends."""
        mask, high = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, score, found, end = mask, 0, self.m, self.m, 0
        get = self.eq.get
        for i, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (~(xh | pv) & mask)
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph <<= 1
            mh <<= 1
            pv = (mh | ~(xv | ph)) & mask
            mv = ph & xv & mask
            if score < found:
                found, end = score, i
        return found, end


class EditMatcher:
    """Finds test items in texts within an error budget of error_rate times their length, by characters.

    An item with budget k is split into k + 1 pieces; k edits leave at least one piece whole, so an
    Aho-Corasick search for all pieces misses no match. Hits of an item whose windows overlap are
    verified together, so a text costs no more than its length for each item. Items too short for a
    single edit are looked for as whole words, so that they aren't found inside longer ones; blank
    items are in no text.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.items: list[tuple[int, str, int]] = []
        self.myers: dict[int, Myers] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text)
            if not text:
                continue
            k, at = int(error_rate * len(text)), len(self.items)
            self.items.append((item_id, text, k))
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[a:b], []).append((at, a))
        self.find = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.find.add_word(piece, (len(piece), places))
        if pieces:
            self.find.make_automaton()
        self.any = bool(pieces)

    def matches(self, text: str | None, first: bool = False) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) for each item found, or for one item only."""
        if not text or not self.any:
            return []
        text = normalise(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.find.iter(text):
            for at, offset in places:
                _, item, k = self.items[at]
                begin = end + 1 - size - offset
                if not k and (text[begin - 1 : begin].isalnum() and begin or text[end + 1 : end + 2].isalnum()):
                    continue
                lo, hi = max(0, begin - k), min(len(text), begin + len(item) + k)
                own = windows.setdefault(at, [])
                if own and lo <= own[-1][1]:
                    own[-1][0] = min(own[-1][0], lo)
                    own[-1][1] = max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        out = []
        for at, own in sorted(windows.items()):
            item_id, item, k = self.items[at]
            best = (k + 1, 0)
            for lo, hi in own:
                if hi - lo < len(item) - k:
                    continue
                exact = text.find(item, lo, hi)
                if not k:  # a window begins with an item
                    exact = lo
                if exact >= 0:
                    best = (0, exact + len(item))
                    break
                if at not in self.myers:
                    self.myers[at] = Myers(item)
                distance, end = self.myers[at].best(text[lo:hi])
                best = min(best, (distance, lo + end))
            if best[0] <= k:
                out.append((item_id, *best))
                if first:
                    break
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> list[list[tuple[int, str]]]:
    """The test items in blocks of about block_chars characters, which bound what an executor holds; read once."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    blocks: list[list[tuple[int, str]]] = [[]]
    size = 0
    for r in items.toLocalIterator():
        if size >= block_chars:
            blocks.append([])
            size = 0
        blocks[-1].append((r.item_id, r.text))
        size += len(r.text)
    return blocks


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id long, item_id long, distance int, end_pos int): each test item that each text holds within its budget.

    Lower case and collapsed white space are compared; distance counts single-character edits. Items
    go to the executors in blocks of block_chars characters, one pass over the texts for each block,
    without a shuffle. Items too short for one edit are found as whole words. Null and empty texts hold
    nothing; null and blank items are in no text; null ids are carried; repeated rows and repeated items
    each give their own rows; very long texts are searched whole; extra columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, end_pos int"
    found = None
    for block in _blocks(benchmark, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block: list = block) -> Iterator[pa.RecordBatch]:
            matcher = EditMatcher(block, error_rate)
            for b in batches:
                out = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True) for m in matcher.matches(t.as_py())]
                if out:
                    d, i, k, e = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(k, pa.int32()), pa.array(e, pa.int32())], ["doc_id", "item_id", "distance", "end_pos"])

        part = map_arrow(rows, run, schema, "decontaminate")
        found = part if found is None else found.unionByName(part)
    return found


def is_leaked(benchmark: DataFrame, text: Column, item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> Column:
    """Boolean column, never null: does this text hold a test item? A filter on it needs no shuffle; repeated rows are alike."""
    held: Column = F.lit(False)
    for block in _blocks(benchmark, item_id, item_text, block_chars):
        held = held | arrow_column(_Flag(block, error_rate), "boolean", "decontaminate", text.cast("string"))
    return held


class _Flag:
    """Whether texts hold an item; the matcher is built where it is used, once for a task."""

    def __init__(self, block: list[tuple[int, str]], error_rate: float):
        self.block, self.error_rate, self.matcher = block, error_rate, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"matcher": None}

    def __call__(self, texts: pa.Array) -> pa.Array:
        self.matcher = self.matcher or EditMatcher(self.block, self.error_rate)
        return pa.array([bool(self.matcher.matches(t.as_py(), first=True)) for t in texts], pa.bool_())
