"""Exact top-k inner products by a pivot-distance index: nearest pivot, distance to it, sorted annuli, triangle bounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.llm.common import map_arrow, written

#: Pivots, rows of an index block, width of the finest annulus as a share of the largest norm, blocks of a query group.
PIVOTS, BLOCK_ROWS, FINE, GROUP = 64, 4096, 1 / 256, 32
_EXACT = float(1 << 52)


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id long, v array<long>): floor(scale * x) of each component; rows with nulls or non-finite components are left out.

    Components beyond the range of a long are clamped to it.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad).select("vec_id", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floating-point products where every sum fits 52 bits."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < _EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of a row, ties to the smaller id."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= cut)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    """One more component that gives every vector the squared norm top, so that nearest means largest product."""
    x = x.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, sq))


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, visits: Callable[[DataFrame, int], None] | None = None
) -> DataFrame:
    """(query_id long, rank int, vec_id long, score long): for each row whose id is divisible by `every` the k best other rows.

    The index sample is `pivots` vectors (those whose ids hash lowest); every vector is indexed. The
    vectors are lifted to one norm, where the largest product is the nearest neighbour; each is keyed
    by its nearest pivot and its distance to it. A histogram (at most pivots / FINE rows) cuts each
    pivot's distances into annuli of about block_rows vectors; crowded ones are split by hash. A
    query first searches its own block; its k-th score there bounds a radius, and only annuli that
    the triangle inequality leaves within it are visited, in groups of queries by home block. Vectors are
    sent once for each group that needs their annulus; no task holds more than one block and one
    group. Results are exact. Repeated ids count as separate rows, but a query never meets a row with
    its own id. Vectors of a dimension other than the most common one, null or non-finite ones, and
    null ids take no part; ties go to the smaller id; extra columns are ignored; fewer than k rows
    give them all; no rows give no rows. visits is told (query_id, block) of all visits beyond a query's
    own block, and the number of blocks: on vectors without clusters, as random directions are, the
    triangle inequality leaves nearly all blocks, and the search reads them all.
    """
    spark = vectors.sparkSession
    ints = written(integer_vectors(vectors, vec_id, vector, scale), "vectors")
    dims = ints.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    out = "query_id long, rank int, vec_id long, score long"
    if dims is None or dims.n == 0:
        return spark.createDataFrame([], out)
    dim = dims.n
    ints = ints.where(F.size("v") == dim)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    top = float(ints.agg(F.max(norm)).first()[0])
    reach = max(1.0, np.sqrt(top))
    sample = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    centres = _lifted(np.array([r.v for r in sample], np.int64), top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _distances(_lifted(_matrix(b.column(1), dim), top), centres)
                cell = d.argmin(axis=1)
                dist = d[np.arange(len(d)), cell]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(dist), pa.array((dist / (reach * FINE)).astype(np.int32))], ["vec_id", "v", "cell", "dist", "fine"])

    keyed = written(map_arrow(ints.select("vec_id", "v"), assign, "vec_id long, v array<long>, cell int, dist double, fine int", "topk"), "index")
    bins = sorted((r.cell, r.fine, r.n, r.low, r.high) for r in keyed.groupBy("cell", "fine").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect())
    # annuli: (first block, parts, cell, low, high); a bin above block_rows is split by hash into parts
    annuli: list[list] = []
    place: dict[tuple[int, int], int] = {}
    for cell, fine, n, low, high in bins:
        last = annuli[-1] if annuli else None
        if last and last[1] == cell and last[0] + n <= block_rows:
            last[0], last[3] = last[0] + n, high
        else:
            annuli.append([n, cell, low, high])
        place[cell, fine] = len(annuli) - 1
    parts = np.array([-(-a[0] // block_rows) for a in annuli])
    first = np.concatenate([[0], np.cumsum(parts)])
    cells = np.array([a[1] for a in annuli])
    low, high = np.array([a[2] for a in annuli]), np.array([a[3] for a in annuli])
    mapping = spark.createDataFrame([(c, f, int(first[a]), int(parts[a])) for (c, f), a in place.items()], "cell int, fine int, first long, parts long")
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))).alias("block")
    blocks = written(keyed.join(F.broadcast(mapping), ["cell", "fine"]).select(block, "vec_id", "v", "dist"), "blocks")

    def home(table: pa.Table) -> pa.Table:
        """Queries of one block: their bound from the block itself, and the other blocks they need."""
        ids = table.column("vec_id").to_numpy()
        at = np.flatnonzero(ids % every == 0)
        names = ["query_id", "v", "home", "target", "first_search", "vec_id", "score"]
        rows: list[list] = [[] for _ in names]
        own = int(table.column("block")[0].as_py())
        x = _matrix(table.column("v"), dim)
        for begin in range(0, len(at), 1024):
            part = at[begin : begin + 1024]
            s = scores(x[part], x)
            # without a lift of its own a query's distances order the vectors exactly as its products do
            flat = np.c_[x[part].astype(np.float64), np.zeros(len(part))]
            own_norm = (flat * flat).sum(axis=1)
            near = _distances(flat, centres)
            for i, p in enumerate(part):
                others = np.flatnonzero(ids != ids[p])
                pick = others[best(s[i, others], ids[others], k)]
                if len(pick) >= k:
                    bound = np.sqrt(max(0.0, own_norm[i] + top - 2.0 * float(s[i, pick[-1]]))) + 1e-6 * reach
                    gap = np.maximum(low - near[i, cells], near[i, cells] - high)
                    needed = np.flatnonzero(gap <= bound)
                else:
                    needed = np.arange(len(cells))
                targets = [b for a in needed for b in range(first[a], first[a + 1]) if b != own]
                n, m = len(pick), len(targets)
                rows[0] += [int(ids[p])] * (n + m)
                rows[1] += [None] * n + [x[p].tolist()] * m
                rows[2] += [own] * (n + m)
                rows[3] += [None] * n + [int(b) for b in targets]
                rows[4] += [True] * n + [False] * m
                rows[5] += ids[pick].tolist() + [None] * m
                rows[6] += s[i, pick].tolist() + [None] * m
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)

    found = written(blocks.groupBy("block").applyInArrow(home, "query_id long, v array<long>, home long, target long, first_search boolean, vec_id long, score long"), "searched")
    near = found.where("first_search").select("query_id", "vec_id", "score")
    asks = found.where("not first_search").select("query_id", "v", F.floor(F.col("home") / GROUP).alias("group"), F.col("target").alias("block"))
    if visits:
        visits(asks.select("query_id", "block"), int(first[-1]))
    wanted = asks.select(F.col("block").alias("target"), F.col("group").alias("for_group")).distinct()
    sent = blocks.join(wanted, F.col("block") == F.col("target")).select(F.col("target").alias("to_block"), "for_group", "vec_id", "v")

    def visit(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names, kinds = ["query_id", "vec_id", "score"], [pa.int64()] * 3
        got: list[list] = [[], [], []]
        if queries.num_rows and rows.num_rows:
            q, x = _matrix(queries.column("v"), dim), _matrix(rows.column("v"), dim)
            qid, ids = queries.column("query_id").to_numpy(), rows.column("vec_id").to_numpy()
            for begin in range(0, len(q), 1024):
                s = scores(q[begin : begin + 1024], x)
                for i, own in enumerate(qid[begin : begin + 1024]):
                    others = np.flatnonzero(ids != own)
                    pick = others[best(s[i, others], ids[others], k)]
                    got[0] += [int(own)] * len(pick)
                    got[1] += ids[pick].tolist()
                    got[2] += s[i, pick].tolist()
        return pa.table([pa.array(c, t) for c, t in zip(got, kinds, strict=True)], names)

    far = asks.groupBy("block", "group").cogroup(sent.groupBy("to_block", "for_group")).applyInArrow(visit, "query_id long, vec_id long, score long")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
