"""SimHash near-duplicates: fingerprints, ball hashing with masked blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import P, arrow_column, map_arrow, written
from skein.llm.graph import components

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_CHUNK = 1 << 18
#: Fingerprints are cut into four blocks of 16 bits; a link of at most three bits has a block with such a bit.
BLOCKS, WIDTH, RADIUS = 4, 16, 3


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one text, unsigned. Null and blank texts have fingerprint zero."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams, repeat(seed))), np.uint8)
    total = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        # eight one-byte counters share a machine word; 255 additions can't overflow them
        lanes = np.unpackbits(digests[8 * at : 8 * (at + _CHUNK)]).view(np.uint64).reshape(-1, 8)
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        total += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id long, fp long): one row for each input row, the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "doc_id long, fp long", "simhash")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_LOW = (1 << 48) - 1


def variants(fps: DataFrame) -> DataFrame:
    """(key long, rest int): the radius-1 ball around each fingerprint in the 48 bits that each mask leaves.

    A link of three bits has a block holding one of them; with that block masked, two bits are
    left, which half-radius balls of both ends share. Each fingerprint emits 4 * (1 + 48) rows.
    The fingerprint is turned until the masked block is on top; the key has the block's number there
    and the variant's 48 bits below, and rest holds the masked bits and which bit was flipped, so
    that both give the fingerprint back.
    """
    rows = []
    for b in range(BLOCKS):
        for i, flip in enumerate([0, *(1 << i for i in range(48))]):
            rows.append(F.struct(F.lit(WIDTH * (BLOCKS - 1 - b)).alias("turn"), F.lit(flip | b << 48).alias("change"), F.lit(i).alias("flip")))
    v = fps.select("fp", F.explode(F.array(*rows)).alias("v"))
    turned = v.select(F.expr("shiftleft(fp, v.turn) | shiftrightunsigned(fp, 64 - v.turn)").alias("t"), "v")
    return turned.select(F.expr(f"(t & {_LOW}L) ^ v.change").alias("key"), F.expr("cast(shiftrightunsigned(t, 48) as int) * 64 + v.flip").alias("rest"))


def _unpacked(key: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key with a masked block, block, fingerprint) of rows of variants()."""
    flips = np.array([0, *(1 << i for i in range(48))], np.uint64)
    block = (key >> np.uint64(48)).astype(np.int64)
    low, top = key & np.uint64(_LOW), (rest >> 6).astype(np.uint64) << np.uint64(48)
    turn = (WIDTH * (BLOCKS - 1 - block)).astype(np.uint64)
    back = lambda x: (x >> turn) | (x << ((np.uint64(64) - turn) & np.uint64(63)))
    return back(low), block, back((low ^ flips[rest & 63]) | top)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _links(key: np.ndarray, block: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within groups of equal (block, key), enough to connect all that lie within three bits.

    Rows come sorted by (block, key). Inside a group the masked block's value tells members apart:
    equal values are at most two bits apart and are chained; values one bit apart are joined by one
    link; members without a flip are compared by value up to three bits. Each lookup is a binary
    search, so a group of g members costs g log g, never g squared.
    """
    same = (key[1:] == key[:-1]) & (block[1:] == block[:-1])
    keep = np.zeros(len(key), bool)
    keep[1:] |= same
    keep[:-1] |= same
    key, block, fp = key[keep], block[keep], fp[keep]
    out_a, out_b = [], []
    for b in range(BLOCKS):
        at = block == b
        if not at.any():
            continue
        k, f = key[at], fp[at]
        mask = np.uint64(((1 << WIDTH) - 1) << (WIDTH * b))
        full = k | (f & mask)  # the variant with its own block put back
        order = np.lexsort((f, full))
        full, f, k = full[order], f[order], k[order]
        first = np.r_[True, full[1:] != full[:-1]]
        head = np.maximum.accumulate(np.where(first, np.arange(len(full)), 0))
        out_a.append(f[~first])
        out_b.append(f[head[~first]])
        reps, rep_f = full[first], f[first]
        exact = (f & ~mask) == k
        ex = np.unique(f[exact])
        ones = [1 << (WIDTH * b + i) for i in range(WIDTH)]
        far = [ones[i] | ones[j] | ones[m] for i in range(WIDTH) for j in range(i) for m in range(j)]
        for values, ids, flips in ((reps, rep_f, ones), (ex, ex, far)):
            if len(values) < 2:
                continue
            _, group, sizes = np.unique(values & ~mask, return_inverse=True, return_counts=True)
            values, ids = values[sizes[group] > 1], ids[sizes[group] > 1]
            if not len(values):
                continue
            for flip in flips:
                want = values ^ np.uint64(flip)
                pos = np.minimum(np.searchsorted(values, want), len(values) - 1)
                hit = values[pos] == want
                out_a.append(ids[hit])
                out_b.append(ids[pos[hit]])
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, z = np.concatenate(out_a), np.concatenate(out_b)
    ok = (a != z) & (_popcount(a ^ z) <= RADIUS)
    pairs = np.unique(np.stack([np.maximum(a[ok], z[ok]), np.minimum(a[ok], z[ok])], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(fps: DataFrame) -> DataFrame:
    """(a long, b long): links between distinct fingerprints within three bits that connect all such pairs.

    fps must hold each fingerprint once. Every pair within three bits ends in one component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, goal = 0, 1 << 16

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal held, size, goal
            key, rest = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
            a, b = _links(*_unpacked(key[:cut], rest[:cut]))
            held, size = [(key[cut:], rest[cut:])], len(key) - cut
            goal = max(1 << 16, 2 * size)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]) if len(a) else None

        for x in batches:
            held.append((x.column(0).to_numpy().view(np.uint64), x.column(1).to_numpy()))
            size += x.num_rows
            if size >= goal and (out := flush(False)) is not None:
                yield out
        if size and (out := flush(True)) is not None:
            yield out

    # few fingerprints grow to many variants: spread them before
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = variants(fps.repartition(n)).repartition("key").sortWithinPartitions("key")
    return map_arrow(spread, run, "a long, b long", "simhash").distinct()


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp, root long, component_id) for each row; rows of one component share the root, a fingerprint."""
    docs_fp = written(fingerprints(docs, doc_id, text), "simhash")
    nodes = docs_fp.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = components(links(nodes.select("fp")))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")
    return docs_fp.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: (doc_id long, fp long, component_id long).

    Rows whose fingerprints differ in at most three bits are linked; component_id is the smallest
    doc_id in reach. Copies share a fingerprint, so only distinct fingerprints take part in the
    search. Null and blank texts have fingerprint zero and link like any other; null ids keep their
    row and take the smallest id of their component, or null; rows with one doc_id stay separate
    rows; extra columns are ignored; no rows give no rows.
    """
    return _marked(docs, doc_id, text).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns, without near-duplicates: of each component the row with the smallest doc_id stays.

    Of rows that share this doc_id one stays, of those the one with the smallest fingerprint, and of
    wholly repeated rows any. Components stay apart even where their rows share ids. Rows with a null
    id stay only if no row of their component has an id, and then one does.
    """
    marked = written(_marked(docs, doc_id, text), "simhash-marked")
    first = marked.groupBy("root").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "fp"))).alias("named"), F.min("fp").alias("any"))
    own = marked.where("doc_id is not null").groupBy(F.col("doc_id").alias(f"{P}id")).agg((F.count("*") > 1).alias(f"{P}again"))
    named = first.where("named is not null").select(F.col("named.doc_id").alias(f"{P}id"), F.col("named.fp").alias(f"{P}fp"))
    named = written(named.join(own, f"{P}id"), "simhash-kept")
    of_id = docs[doc_id].cast("long") == named[f"{P}id"]
    kept = docs.join(named.where(~F.col(f"{P}again")), of_id, "left_semi")
    again = named.where(f"{P}again")
    if not again.isEmpty():  # rows that share an id are told apart by their fingerprints
        met = docs.join(again, of_id)
        met = met.where(_fp_column(docs[text].cast("string")) == F.col(f"{P}fp")).dropDuplicates([f"{P}id", f"{P}fp"])
        kept = kept.unionByName(met.select(*(docs[c] for c in docs.columns)))
    nameless = docs.where(F.col(doc_id).cast("long").isNull())
    if not nameless.isEmpty():
        alone = first.where("named is null").select(F.col("any").alias(f"{P}fp"))
        tagged = nameless.withColumn(f"{P}fp", _fp_column(F.col(text).cast("string")))
        kept = kept.unionByName(tagged.join(alone, f"{P}fp", "left_semi").dropDuplicates([f"{P}fp"]).drop(f"{P}fp"))
    return kept


def _fp_column(text: Column) -> Column:
    """The fingerprint of a text column."""
    return arrow_column(lambda texts: pa.array([_signed(fingerprint(t.as_py())) for t in texts], pa.int64()), "long", "simhash", text)
