"""Mixing sources to target weights: Pfair windows, earliest deadline first, in independent periods."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import gcd

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import P, map_arrow, written

#: Rows in a block; resolution of the weights, which bounds the period of a schedule.
BLOCK_DOCS, UNIT = 8, 1 << 16


def integer_weights(weights: dict[str | None, float], unit: int = UNIT) -> dict[str | None, int]:
    """Weights as positive multiples of 1 / unit of their sum, divided by what they share."""
    total = sum(weights.values())
    w = {s: max(1, round(x / total * unit)) for s, x in weights.items()}
    share = gcd(*w.values()) if w else 1
    return {s: x // share for s, x in w.items()}


def earliest_deadline(w: list[int], slots: int, most: list[int] | None = None) -> list[int]:
    """The source of each slot, from slot 0 on: at most `slots`, ended early when a source has its `most` blocks.

    Block j of a source with share s of the weights has the window [floor(j / s), ceil((j + 1) / s)).
    On one processor earliest deadline first meets all deadlines, so after any number of slots every
    source is less than one block from its share.
    """
    total = sum(w)
    ready = [(-(-total // x), i, 0) for i, x in enumerate(w)]
    heapq.heapify(ready)
    wait: list[tuple[int, int, int]] = []
    out = []
    for t in range(slots):
        while wait and wait[0][0] <= t:
            _, i, j = heapq.heappop(wait)
            heapq.heappush(ready, (-(-(j + 1) * total // w[i]), i, j))
        _, i, j = heapq.heappop(ready)
        out.append(i)
        if most and j + 1 >= most[i]:
            break
        heapq.heappush(wait, ((j + 1) * total // w[i], i, j + 1))
    return out


def plan(blocks: dict[str | None, int], weights: dict[str | None, int], segment: int = UNIT) -> Iterator[tuple[int, int, list, list[int], list[int]]]:
    """Segments of the schedule: (first slot, slots, sources, weights, blocks of each source placed before).

    A phase runs until a source has no block left; then the others go on with their weights, so
    every block of every source is placed. After a whole period, as many slots as the weights'
    sum, each source has exactly its weight in blocks, so periods are alike and can be scheduled
    apart; short ones come together, in about `segment` slots. Only the broken period that ends a phase is worked out here, to see what is left.
    """
    left = {s: n for s, n in sorted(blocks.items(), key=lambda x: (x[0] is not None, x[0] or "")) if n}
    done = dict.fromkeys(left, 0)
    slot = 0
    while left:
        names = list(left)
        share = gcd(*(weights[s] for s in names))
        w = [weights[s] // share for s in names]
        whole, most = min(left[s] // x for s, x in zip(names, w, strict=True)), max(1, segment // sum(w))
        while whole:
            n = min(whole, most)
            yield slot, n * sum(w), names, w, [done[s] for s in names]
            slot += n * sum(w)
            whole -= n
            for s, x in zip(names, w, strict=True):
                done[s] += n * x
                left[s] -= n * x
        if all(left.values()):
            part = earliest_deadline(w, sum(w), [left[s] for s in names])
            yield slot, len(part), names, w, [done[s] for s in names]
            slot += len(part)
            for i in part:
                done[names[i]] += 1
                left[names[i]] -= 1
        left = {s: n for s, n in left.items() if n}


def _ranked(docs: DataFrame, doc_id: str, source: str) -> tuple[DataFrame, dict[tuple[int, str | None], int], dict[str | None, int]]:
    """Rows (shard, doc_id, source, at) with at counting a source's rows within a range; rows before each; totals.

    Ranges split a hot source by id, so no task holds a whole source. The driver gets one row for
    each range and source in it: ranges plus sources at most.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, counts = TaskContext.get().partitionId(), {}
        for b in batches:
            at = []
            for s in b.column(0).to_pylist():
                at.append(counts.get(s, 0))
                counts[s] = at[-1] + 1
            yield pa.RecordBatch.from_arrays([pa.array([shard] * b.num_rows, pa.int32()), b.column(0), b.column(1), pa.array(at, pa.int64())], ["shard", "source", "doc_id", "at"])

    ranged = keys.repartitionByRange(n, "source", "doc_id").sortWithinPartitions("source", "doc_id")
    rows = written(map_arrow(ranged, run, "shard int, source string, doc_id long, at long", "mixing"), "mix")
    before, totals = {}, {}
    for r in sorted(rows.groupBy("shard", "source").count().collect(), key=lambda r: r.shard):
        before[r.shard, r.source] = totals.get(r.source, 0)
        totals[r.source] = totals.get(r.source, 0) + r["count"]
    return rows, before, totals


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    temperature: float = 0.5,
    block_docs: int = BLOCK_DOCS,
    unit: int = UNIT,
) -> DataFrame:
    """(doc_id long, source string, block long, slot long, offset int): the place of every row in the mixed order.

    Read rows by (slot, offset). Each source is cut into blocks of block_docs rows by ascending id
    (null ids first). While no source has run out, after any number of slots each source has had
    its weight's share of them with less than one block of deviation; when one runs out, the same
    holds for the rest from there on, with their weights renormalised. No row is dropped or
    repeated. Weights default to row counts to the power of temperature; sources without a given
    weight, null among them, take the smallest given one. Repeated rows each have a place; extra
    columns are ignored; no rows give no rows. Weights are multiples of 1 / unit of their sum, so
    that against the weights as given the deviation may grow by a block in every 2 * unit slots. The
    driver holds a row for each period of about `unit` slots and each end of a source, with one count
    for each source.
    """
    spark = docs.sparkSession
    rows, before, totals = _ranked(docs, doc_id, source)
    given = weights or {s: n**temperature for s, n in totals.items()}
    least = min(given.values(), default=1.0)
    w = integer_weights({s: given.get(s, least) for s in totals}, unit)
    names = sorted(totals, key=lambda s: (s is not None, s or ""))
    index = {s: i for i, s in enumerate(names)}
    segments = [(a, n, [index[s] for s in own], x, skip) for a, n, own, x, skip in plan({s: -(-n // block_docs) for s, n in totals.items()}, w, unit)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                placed = earliest_deadline(r["w"], r["slots"])
                at = list(r["skip"])
                block = []
                for i in placed:
                    block.append(at[i])
                    at[i] += 1
                sources = pa.array([r["own"][i] for i in placed], pa.int32())
                yield pa.RecordBatch.from_arrays([sources, pa.array(block, pa.int64()), pa.array(range(r["slot"], r["slot"] + len(placed)), pa.int64())], ["source_no", "block", "slot"])

    schema = "slot long, slots long, own array<int>, w array<long>, skip array<long>"
    slots = map_arrow(spark.createDataFrame(segments, schema).repartition(max(1, min(len(segments), 1024))), run, "source_no int, block long, slot long", "mixing")
    firsts = spark.createDataFrame([(k[0], k[1], index[k[1]], n) for k, n in before.items()], f"shard int, {P}s string, source_no int, {P}first long")
    placed = rows.join(F.broadcast(firsts), (rows["shard"] == firsts["shard"]) & rows["source"].eqNullSafe(firsts[f"{P}s"]))
    at = F.col("at") + F.col(f"{P}first")
    placed = placed.select("doc_id", "source", "source_no", F.floor(at / block_docs).cast("long").alias("block"), F.pmod(at, F.lit(block_docs)).cast("int").alias("offset"))
    return placed.join(slots, ["source_no", "block"]).select("doc_id", "source", "block", "slot", "offset")


def in_mixed_order(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", **settings) -> DataFrame:  # noqa: ANN003
    """All rows and columns of docs, range-partitioned and sorted so that they are written in the mixed order.

    Rows that share an id are kept together at its first place.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = mix(docs, doc_id=doc_id, source=source, **settings).groupBy("doc_id").agg(F.min(F.struct("slot", "offset")).alias(f"{P}at"))
    order = order.select(F.col("doc_id").alias(f"{P}id"), f"{P}at")
    joined = docs.join(order, docs[doc_id].cast("long").eqNullSafe(order[f"{P}id"]))
    by = [f"{P}at.slot", f"{P}at.offset"]
    return joined.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*(docs[c] for c in docs.columns))
