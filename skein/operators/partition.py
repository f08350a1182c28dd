"""Hash-range partitions: slices of 256 buckets, weights, plans, agreement between devices."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions.ids import BUCKETS

Slice = tuple[int, int]


def equal_slice(devices: int, index: int) -> Slice:
    if not 0 <= index < devices:
        raise ValueError(f"index {index} is not below {devices}")
    edge = [BUCKETS * i // devices for i in (index, index + 1)]
    return edge[0], edge[1]


def ranges_from_weights(order: list[str], weights: dict[str, float]) -> dict[str, Slice]:
    """Ranges without gaps, by largest remainder; a positive weight gets at least one bucket, zero an empty range."""
    names = list(dict.fromkeys([*order, *weights]))
    w = {n: float(weights.get(n) or 0) for n in names}
    held = [n for n in names if w[n] > 0]
    if not 0 < len(held) <= BUCKETS or min(w.values()) < 0:
        raise ValueError("weights must not be negative, and 1 to 256 of them positive")
    total = sum(w.values())
    shares = {n: w[n] / total * BUCKETS for n in held}
    sizes = {n: int(s) for n, s in shares.items()}
    by_rest = sorted(held, key=lambda n: (sizes[n] - shares[n], names.index(n)))
    for n in by_rest[: BUCKETS - sum(sizes.values())]:
        sizes[n] += 1
    for n in held:
        if not sizes[n]:
            sizes[max(held, key=sizes.__getitem__)] -= 1
            sizes[n] = 1
    out, at = {}, 0
    for n in names:
        out[n] = (at, at := at + sizes.get(n, 0))
    return out


def weighted_ranges(weights: DataFrame) -> DataFrame:
    """The same allotment of (ord, name, weight) as a query, without the fix for empty ranges: (name, lo, hi)."""
    whole = W.partitionBy()
    share = F.col("weight") * BUCKETS / F.sum("weight").over(whole)
    rows = weights.withColumn("share", share).withColumn("size", F.floor("share"))
    spare = F.lit(BUCKETS) - F.sum("size").over(whole)
    place = F.row_number().over(W.orderBy(F.desc(F.col("share") - F.col("size")), "ord"))
    rows = rows.withColumn("spare", spare).withColumn("place", place).withColumn("size", F.col("size") + F.when(F.col("place") <= F.col("spare"), 1).otherwise(0))
    hi = F.sum("size").over(W.orderBy("ord").rowsBetween(W.unboundedPreceding, 0))
    return rows.select("ord", "name", (hi - F.col("size")).cast("int").alias("lo"), hi.cast("int").alias("hi")).drop("ord")


def read_plan(text: str | None) -> dict[str, Slice] | None:
    """Ranges of a plan of either version; None if absent, unreadable or without an allotment."""
    try:
        plan = json.loads(text or "")
    except ValueError:
        return None
    if not isinstance(plan, dict):
        return None
    if isinstance(plan.get("ranges"), dict) and plan["ranges"]:
        return {k: (int(v[0]), int(v[1])) for k, v in plan["ranges"].items()}
    if isinstance(plan.get("assignments"), dict) and plan.get("devices"):
        return {k: equal_slice(int(plan["devices"]), int(i)) for k, i in plan["assignments"].items()}
    return None


def write_plan(ranges: dict[str, Slice], weights: dict[str, float] | None = None, by: str = "", at: str = "") -> str:
    """Version 2 plan text; overlapping or out-of-bounds ranges are refused."""
    last = 0
    for name, (lo, hi) in sorted(ranges.items(), key=lambda x: x[1]):
        if not 0 <= lo <= hi <= BUCKETS:
            raise ValueError(f"{name}: {lo}..{hi} is out of bounds")
        if lo < last and lo < hi:
            raise ValueError(f"{name} overlaps another range")
        last = max(last, hi)
    return json.dumps({"version": 2, "ranges": {k: list(v) for k, v in ranges.items()}, "weights": weights or {}, "updated_by": by, "updated_at": at})


def resolve(flag: Slice | None, plan: dict[str, Slice] | None, device: str, environment: Slice | None, config: Slice | None) -> Slice | None:
    """Flag before plan before environment before configuration; a plan without the device gives it nothing."""
    if flag is not None:
        return flag
    if plan is not None:
        return plan.get(device, (0, 0))
    return environment if environment is not None else config


def merge_shares(existing: dict[str, float], shares: dict[str, float] | None = None, drop: tuple[str, ...] = (), equal: list[str] | None = None) -> dict[str, float]:
    """Weights of a plan after a change: order kept, names dropped, newcomers at the end."""
    base = dict.fromkeys(equal, 1.0) if equal is not None else dict(existing)
    base |= shares or {}
    return {k: v for k, v in base.items() if k not in drop}


def reporting(markers: DataFrame, own: str, dropped: DataFrame) -> DataFrame:
    """(device): every device with a marker and this one, less those dropped, each once; they get equal shares."""
    here = markers.sparkSession.createDataFrame([(own,)], "device string")
    seen = markers.where("device is not null and device <> ''").select("device").unionByName(here).distinct()
    return seen.join(dropped.select("device"), "device", "left_anti")


def remaining(shards: DataFrame, finished: DataFrame) -> DataFrame:
    """Shards a scan still has to read: those not among the finished ones, each once, so that a stopped scan goes on."""
    return shards.select("shard").distinct().join(finished.select("shard"), "shard", "left_anti")


def splits(plan: dict[str, Slice] | None) -> bool:
    return bool(plan) and sum(1 for lo, hi in plan.values() if lo < hi) > 1


def describe(plan: dict[str, Slice] | None) -> list[str]:
    return [f"{n}: {describe_slice(s)}" for n, s in sorted((plan or {}).items(), key=lambda x: (x[1], x[0]))]


def describe_slice(part: Slice | None) -> str:
    if part is None:
        return "the whole corpus"
    lo, hi = part
    return f"buckets {lo}-{hi - 1} ({100 * (hi - lo) / BUCKETS:.1f}%)" if lo < hi else "no share (0%)"


def owners(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with the device whose range holds their bucket; ranges are spelt out as buckets, so the join is by equality."""
    return rows.join(_buckets(plan).select("device", "bucket"), "bucket", "left").select(*rows.columns, "device")


def _buckets(plan: DataFrame) -> DataFrame:
    """One row for each device and bucket it holds; empty ranges hold none."""
    return plan.where("lo < hi").select("device", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("bucket"))


def overlaps(plan: DataFrame) -> DataFrame:
    """Pairs of devices whose ranges share a bucket."""
    a, b = (_buckets(plan).withColumnRenamed("device", f"device_{x}") for x in "ab")
    return a.join(b, "bucket").where("device_a < device_b").select("device_a", "device_b").distinct()


def unassigned(plan: DataFrame) -> DataFrame:
    """One row: buckets outside all ranges."""
    held = plan.where("lo < hi").select(F.explode(F.sequence("lo", F.col("hi") - 1)).alias("b"))
    return held.agg((F.lit(BUCKETS) - F.countDistinct("b")).alias("unassigned"))


def agreement(plan: DataFrame, markers: DataFrame, now: Column, fresh_hours: int = 24) -> DataFrame:
    """Each planned device with its latest marker: missing, stale, mismatch or ok, and whether it runs."""
    latest = markers.groupBy("device").agg(F.max_by(F.struct("lo", "hi", "state", "updated_at"), "updated_at").alias("m"))
    j = plan.join(latest, "device", "left")
    same = (F.col("lo") == F.col("m.lo")) & (F.col("hi") == F.col("m.hi"))
    fresh = F.col("m.updated_at") >= now - F.expr(f"interval {fresh_hours} hours")
    verdict = F.when(F.col("m").isNull(), "missing").when(~fresh, "stale").when(~same, "mismatch").otherwise("ok")
    return j.select("device", "lo", "hi", verdict.alias("verdict"), F.coalesce(fresh & (F.col("m.state") == "running"), F.lit(False)).alias("running"))
