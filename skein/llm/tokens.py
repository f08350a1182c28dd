"""Token ids in a range-coded binary format: one shared frequency table, independent blocks of interleaved lanes."""

from __future__ import annotations

import codecs
import json
import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import P, keeps_cache, map_arrow, written

#: Frequencies add up to 2**BITS; a lane's state lies in [2**31, 2**63) and moves 32 bits at a time.
BITS = 20
LOW = np.uint64(1 << 31)
LANES = 1024
BLOCK_TOKENS = 1 << 18
CHECK_STEPS = 128
MAGIC = b"SKR1"
_HEAD = struct.Struct("<4sQHII")
#: Longest piece whose ids the encoder keeps.
KEPT_SIGNS = 64

# white space but for space and line feed
_ODD_SPACE = r"\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# a space before white space, or at the end, doesn't go with what follows
_SPACE_RUN = rf" ([ \n{_ODD_SPACE}]|\z)"
# any other line feed is a pre-token of its own
_FEED_RUN = rf"[{_ODD_SPACE}]\n|\n[{_ODD_SPACE}]|\n\n([ \n]|\z)"
_HEAD_SIGN = "\x00"
_FIRST, _NONE = pa.scalar(_HEAD_SIGN, pa.large_string()), pa.scalar("", pa.large_string())
# signs that are one pre-token together, after letters or digits
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Latin letters below U+0250, or digits: one pre-token with the space before
_WORD = r"^\x00?([A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+|[0-9]+)\z"
# byte-level models write each byte as one sign: visible Latin-1 as it is, the rest from U+0100 on
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}
#: The sign of each byte; a line feed stays, as it parts the words that are mapped together.
_MAPPED = "".join("\n" if b == 10 else _BYTE_SIGNS.get(b, chr(b)) for b in range(256))


def _runs(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """flat[start : start + len] of all starts, one after the other."""
    ends = np.cumsum(lens)
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]


class TextEncoder:
    """Ids of whole texts, equal to encode(text, add_special_tokens=False) of the tokenizers library.

    A byte-level BPE without normaliser splits text before it merges, and always before a single
    space that a visible character follows and around a line feed with no other white space beside
    it. So texts are cut there, columns at a time; each distinct piece is parted from its closing
    signs, columns at a time too, and what is left is encoded once by the library, or by its model
    alone if it is one word. A bounded cache keeps these ids. Texts with other spaces, with an added
    token or a zero byte, and those of other kinds of tokenizers, are encoded whole.
    """

    def __init__(self, path: str, cache_entries: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(Path(path).read_text())
        pre = spec.get("pre_tokenizer") or {}
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        self.cut = (
            spec.get("normalizer") is None
            and spec["model"]["type"] == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not spec.get("truncation")
            and not spec.get("padding")
        )
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.model, self.limit = self.tokenizer.model, cache_entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.Array) -> dict[str, bytes]:
        """Ids of pieces; words by the library's model alone, their bytes are mapped to its signs here."""
        one = pc.match_substring_regex(pieces, _WORD)
        words, others = (pieces.filter(x).to_numpy(zero_copy_only=False).tolist() for x in (one, pc.invert(one)))
        tokenize, code = self.model.tokenize, self.code
        found: dict[str, bytes] = {}
        if words:
            lines = (" " + "\n ".join(words)).replace(" " + _HEAD_SIGN, "").encode()
            mapped = codecs.charmap_decode(lines, "strict", _MAPPED)[0].split("\n")
            found.update(zip(words, [array(code, [t.id for t in tokenize(x)]).tobytes() for x in mapped], strict=True))
        if others:
            found.update(zip(others, self._whole([p[1:] if p[:1] == _HEAD_SIGN else " " + p for p in others]), strict=True))
        return found

    def _known(self, pieces: pa.Array) -> list[bytes]:
        """Ids of distinct pieces; when the young cache is full it becomes the old one, and what is used moves back. Long pieces seldom recur and aren't kept."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(young.get, names))
        if None in ids:
            missing = []
            for i, x in enumerate(ids):
                if x is None:
                    known = old.get(names[i])
                    if known is None:
                        missing.append(i)
                    else:
                        ids[i] = young[names[i]] = known
            if missing:
                found = self._learn(pieces.take(pa.array(missing)))
                for i in missing:
                    ids[i] = found[names[i]]
                young.update(found if max(map(len, found)) <= KEPT_SIGNS else {p: x for p, x in found.items() if len(p) <= KEPT_SIGNS})
        return ids

    def _pieces_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after the other, and their numbers; a word and its closing signs are two pre-tokens."""
        stems = pc.ascii_rtrim(pieces, _SIGNS)
        stems = pc.if_else(pc.match_substring_regex(stems, _WORD), stems, pieces)
        lens = pc.subtract(pc.binary_length(pieces), pc.binary_length(stems)).to_numpy()
        _, offsets, data = pieces.buffers()
        ends = np.frombuffer(offsets, np.int64)[pieces.offset + 1 : pieces.offset + len(pieces) + 1]
        signs = _runs(np.frombuffer(data, np.uint8), ends - lens, lens)
        tails = pa.LargeStringArray.from_buffers(len(pieces), pa.py_buffer(np.r_[0, np.cumsum(lens)]), pa.py_buffer(signs))
        stems, tails = stems.dictionary_encode(), pc.binary_join_element_wise(_FIRST, tails, _NONE).dictionary_encode()
        known = self._known(stems.dictionary)
        parts = [*known, *self._known(tails.dictionary)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        index = np.stack([stems.indices.to_numpy(), tails.indices.to_numpy() + len(known)], 1).ravel()
        flat = _runs(np.frombuffer(b"".join(parts), self.dtype), (np.cumsum(sizes) - sizes)[index], sizes[index])
        return flat, sizes[index].reshape(-1, 2).sum(1)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column; null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.cut:
            return [np.frombuffer(x, self.dtype) for x in self._whole(texts.to_pylist())]
        whole = pc.or_(pc.match_substring_regex(texts, _SPACE_RUN), pc.match_substring(texts, _HEAD_SIGN))
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, a))
        out: list[np.ndarray | None] = [None] * len(texts)
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        for i, x in zip(at, self._whole(texts.take(pa.array(at)).to_pylist()), strict=True):
            out[i] = np.frombuffer(x, self.dtype)
        at = np.flatnonzero(~whole.to_numpy(zero_copy_only=False))
        if len(at):
            plain = texts.take(pa.array(at)).cast(pa.large_string())
            apart = pc.replace_substring(plain, "\n", f" {_HEAD_SIGN}\n {_HEAD_SIGN}")
            plain = pc.if_else(pc.match_substring_regex(plain, _FEED_RUN), plain, apart)
            lists = pc.split_pattern(pc.binary_join_element_wise(_FIRST, plain, _NONE), " ")
            coded = lists.flatten().dictionary_encode()
            flat, sizes = self._pieces_ids(coded.dictionary)
            index = coded.indices.to_numpy()
            lens = sizes[index]
            ends = np.cumsum(lens)
            gathered = _runs(flat, (np.cumsum(sizes) - sizes)[index], lens)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            bounds = np.r_[0, ends][offsets]
            for k, i in enumerate(at):
                out[i] = gathered[bounds[k] : bounds[k + 1]]
        return out


_encoders: dict[str, TextEncoder] = {}
keeps_cache("tokens", _encoders.clear)


def _encoder(path: str) -> TextEncoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are parallel already
        _encoders.clear()
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def shared_frequencies(counts: dict[int, int]) -> np.ndarray:
    """Frequencies by id with sum 2**BITS, at least one for each id that occurs."""
    if not counts:
        return np.zeros(1, np.uint64)
    if len(counts) > 1 << BITS:
        raise ValueError(f"more than 2**{BITS} different ids")
    ids = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(i)] for i in ids], np.float64)
    f = np.maximum(1, np.floor(n / n.sum() * (1 << BITS))).astype(np.int64)
    over = int(f.sum()) - (1 << BITS)
    order = np.lexsort((ids, -f))
    if over < 0:
        f[order[0]] -= over
    for i in order:
        if over <= 0:
            break
        cut = min(over, int(f[i]) - 1)
        f[i] -= cut
        over -= cut
    table = np.zeros(int(ids[-1]) + 1, np.uint64)
    table[ids] = f.astype(np.uint64)
    return table


class Coder:
    """Range asymmetric numeral system over one static table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, check_steps: int = CHECK_STEPS) -> bytes:
        """One block: header, checkpoints (words so far, lane states), words, crc32 of all before it."""
        n = len(ids)
        lanes = max(1, min(lanes, n // 64))
        steps = -(-n // lanes)
        f, c = self.freq[ids], self.start[ids]
        most, gap = f << np.uint64(63 - BITS), np.uint64(1 << BITS) - f
        x = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, bytes]] = []
        written_words = 0
        shift = np.uint64(32)
        for step in range(steps - 1, -1, -1):
            at = slice(step * lanes, (step + 1) * lanes)
            xs = x[: min(lanes, n - step * lanes)]
            full = np.flatnonzero(xs >= most[at])
            if len(full):
                out = xs[full]
                words.append(out.astype("<u4"))  # the low 32 bits
                written_words += len(out)
                xs[full] = out >> shift
            q = xs // f[at]
            q *= gap[at]  # (q << BITS) + (xs - q * f) is xs + q * gap
            xs += q
            xs += c[at]
            if step % check_steps == 0:
                marks.append((written_words, x.astype("<u8").tobytes()))
        body = b"".join(
            [
                _HEAD.pack(MAGIC, n, lanes, check_steps, len(marks)),
                *(struct.pack("<Q", w) + s for w, s in reversed(marks)),
                *(w.tobytes() for w in words),
            ]
        )
        return body + struct.pack("<I", zlib.crc32(body))

    def decode(self, block: bytes, part: int | None = None) -> np.ndarray:
        """All ids of a block as unsigned 32-bit integers, or those behind one checkpoint only."""
        body = memoryview(block)[:-4]
        if zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
            raise ValueError("block checksum differs")
        magic, n, lanes, check_steps, marks = _HEAD.unpack_from(body)
        if magic != MAGIC:
            raise ValueError("not a block of this format")
        at, size = _HEAD.size, 8 + 8 * lanes
        words = np.frombuffer(body, "<u4", offset=at + size * marks)
        out = np.empty(n, np.uint32)
        mask, bits, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
        begin, end = (0, n) if part is None else (part * check_steps * lanes, min(n, (part + 1) * check_steps * lanes))
        for k in range(marks) if part is None else [part]:
            (left,) = struct.unpack_from("<Q", body, at + size * k)
            x = np.frombuffer(body, "<u8", lanes, at + size * k + 8).astype(np.uint64)
            for step in range(k * check_steps, min((k + 1) * check_steps, -(-n // lanes))):
                xs = x[: min(lanes, n - step * lanes)]
                slot = xs & mask
                ids = self.symbol.take(slot.view(np.int64))
                out[step * lanes : step * lanes + len(xs)] = ids
                xs >>= bits
                xs *= self.freq.take(ids)
                xs += slot
                xs -= self.start.take(ids)
                low = np.flatnonzero(xs < LOW)
                if len(low):
                    xs[low] = (xs[low] << shift) | words[left - len(low) : left]
                    left -= len(low)
        return out[begin:end]


_TOKENS = "shard int, block long, first long, doc_ids array<long>, lens array<long>, ids binary"
_BLOCKS = "shard int, block long, first long, doc_ids array<long>, lens array<long>, payload binary"


def _slices(batch: pa.RecordBatch, column: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `size` bytes of text each."""
    lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lens, dtype=np.int64) - lens) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts, cuts[1:], strict=False):
        if z > a:
            yield batch.slice(a, z - a)


def _tokenise(tokenizer: str, end_id: int, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype)
        names: list[int | None] = []
        lens: list[int] = []
        parts: list[np.ndarray] = []
        size = block = first = 0
        for batch in batches:
            for piece in _slices(batch, 1):  # texts share the work on their common pieces
                for name, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1)), strict=True):
                    names.append(name)
                    lens.append(len(ids) + 1)
                    parts += [ids, end]
                    size += len(ids) + 1
                    if size >= block_tokens:
                        yield pa.RecordBatch.from_pylist([dict(shard=shard, block=block, first=first, doc_ids=names, lens=lens, ids=np.concatenate(parts).astype("<u4" if encoder.dtype.itemsize == 4 else "<u2").tobytes())], schema)
                        block, first = block + 1, first + size
                        names, lens, parts, size = [], [], [], 0
        if names:
            yield pa.RecordBatch.from_pylist([dict(shard=shard, block=block, first=first, doc_ids=names, lens=lens, ids=np.concatenate(parts).tobytes())], schema)

    return run


def _count(dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n = np.bincount(np.frombuffer(x.as_py(), dtype))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(total[ids])], ["id", "n"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    order: list[Column] | None = None,
    end_id: int = 0,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of all rows of docs to path, in ascending order of `order` (doc_id, then text where ids tie).

    Texts are range-partitioned and tokenised once; the ids go to a compressed table in the shared
    folder, from which the shared frequency table is counted over all documents (at most one row
    for each id of the vocabulary reaches the driver) and blocks are coded one by one. A block holds
    whole documents and closes at the first end past block_tokens. path/blocks has one folder for
    each range, in order; path/table holds the frequencies. Both are written by Spark's commit
    protocol, so lost executors leave no torn files. Null texts are empty (the end id alone), null
    ids come first, repeated rows stay, extra columns are ignored, no rows give no blocks.
    """
    spark = docs.sparkSession
    keys = order or [F.col(doc_id).cast("long")]
    named = [k.alias(f"{P}k{i}") for i, k in enumerate(keys)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *named, F.xxhash64(F.col(text).cast("string")).alias(f"{P}tie"))
    by = [*(f"{P}k{i}" for i in range(len(keys))), f"{P}tie"]
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by, "text")
    tokens = written(map_arrow(ranged.select("doc_id", "text"), _tokenise(tokenizer, end_id, block_tokens), _TOKENS, "tokens"), "tokens")
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    counted = map_arrow(tokens.select("ids"), _count(dtype), "id int, n long", "tokens").groupBy("id").agg(F.sum("n").alias("n"))
    freq = shared_frequencies({r.id: r.n for r in counted.collect()})
    sums = tokens.select("shard", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    base, at = {}, 0
    for r in sorted(sums.collect()):  # one row for each range partition
        base[r.shard], at = at, at + r.n

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            first = pa.array([base[s] + f for s, f in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)], pa.int64())
            payload = pa.array([coder.encode(np.frombuffer(x.as_py(), dtype)) for x in b.column(5)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), first, b.column(3), b.column(4), payload], [f.split()[0] for f in _BLOCKS.split(", ")])

    map_arrow(tokens, code, _BLOCKS, "tokens").write.partitionBy("shard").parquet(f"{path}/blocks")
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, freq long").coalesce(1).write.parquet(f"{path}/table")


def _decoded(spark: SparkSession, path: str, emit: Callable, schema: str) -> DataFrame:
    """emit(doc_ids, first, lens, ids) gives a record batch for each block."""
    rows = spark.read.schema("id int, freq long").parquet(f"{path}/table").collect()  # at most the vocabulary
    freq = np.zeros(max((r.id for r in rows), default=0) + 1, np.uint64)
    for r in rows:
        freq[r.id] = r.freq

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            for i in range(b.num_rows):
                yield emit(b.column(1)[i].values, b.column(0)[i].as_py(), b.column(2)[i].values.to_numpy(zero_copy_only=False), coder.decode(b.column(3)[i].as_py()))

    blocks = spark.read.schema("block long, first long, doc_ids array<long>, lens array<long>, payload binary, shard int").parquet(f"{path}/blocks")
    return map_arrow(blocks.select("first", "doc_ids", "lens", "payload"), run, schema, "tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id long, start long, ids array<long>): every document's ids with the end id, decoded from the files."""

    def emit(names: pa.Array, first: int, lens: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum(lens)])
        return pa.RecordBatch.from_arrays([names, pa.array(first + ends[:-1]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64)))], ["doc_id", "start", "ids"])

    return _decoded(spark, path, emit, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""

    def emit(names: pa.Array, first: int, lens: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        raw = memoryview(ids.astype("<u4").tobytes())
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays([names, pa.array(first + ends[:-1]), pa.array(lens.astype(np.int64)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _decoded(spark, path, emit, "doc_id long, start long, n_tokens long, ids_crc32 long")
