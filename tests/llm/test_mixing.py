import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from skein.llm import mixing
from skein.llm.queries import WEIGHTS, op10_mix_sources


@pytest.mark.parametrize("unit", [7, 60, 65536])
def test_deviation_stays_below_one_block(unit):
    rng = random.Random(unit)
    for _ in range(40):
        blocks = {f"s{i}": rng.randint(1, 90) for i in range(rng.randint(1, 9))}
        weights = mixing.integer_weights({s: rng.choice([0.01, 1, 2.5, rng.random() + 0.001]) for s in blocks}, unit)
        used, phase, active, slots = Counter(), Counter(), None, 0
        for slot, n, names, w, skip in mixing.plan(blocks, weights):
            assert slot == slots
            if names != active:
                phase, active, begun = Counter(), names, slot
            for i in mixing.earliest_deadline(w, n):
                assert used[names[i]] >= skip[i]
                phase[i] += 1
                used[names[i]] += 1
                slots += 1
                for x in range(len(names)):
                    assert abs(phase[x] - Fraction(w[x] * (slots - begun), sum(w))) < 1
        assert dict(used) == blocks and slots == sum(blocks.values())


def test_every_row_has_one_place(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(700)] + [(5, "hot"), (5, "hot"), (None, "a"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("x")).withColumn("text", F.lit("t"))
    got = mixing.mix(df, block_docs=4, unit=30).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    assert len({(r.slot, r.offset) for r in got}) == len(rows)
    assert all(len({r.source for r in got if r.slot == s}) == 1 for s in {r.slot for r in got})
    by = {}
    for r in sorted(got, key=lambda r: (r.slot, r.offset)):
        by.setdefault(r.source, []).append(-1 if r.doc_id is None else r.doc_id)
    assert all(v == sorted(v) for v in by.values())
    ordered = mixing.in_mixed_order(df, block_docs=4, unit=30)
    assert ordered.columns == df.columns and Counter((r.doc_id, r.source) for r in ordered.collect()) == Counter(rows)
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.in_mixed_order(df.limit(0)).collect() == []


def test_given_weights_hold_until_a_source_ends(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 800, "a").otherwise("b").alias("source"))
    got = sorted(mixing.mix(df, {"a": 1.0, "b": 1.0}, block_docs=1).collect(), key=lambda r: r.slot)
    assert all(abs(sum(r.source == "a" for r in got[:n]) - n / 2) < 1 for n in range(1, 400))


def slow_schedule(blocks, weights):
    """Slot by slot with fractions: of the blocks whose window has begun the one with the earliest deadline, ties to the first source."""
    order = sorted(blocks, key=lambda s: (s is not None, s or ""))
    done, out, begun = dict.fromkeys(order, 0), [], 0
    active, base = [s for s in order if blocks[s]], dict.fromkeys(order, 0)
    while active:
        total = sum(weights[s] for s in active)
        t = len(out) - begun
        share = {s: Fraction(weights[s], total) for s in active}
        ready = [(-(-(done[s] - base[s] + 1) // share[s]), k, s) for k, s in enumerate(active) if (done[s] - base[s]) // share[s] <= t]
        s = min(ready)[2]
        out.append((s, done[s]))
        done[s] += 1
        if done[s] == blocks[s]:  # the others go on by their own
            active, begun, base = [x for x in active if x != s], len(out), dict(done)
    return out


@pytest.mark.parametrize("table", ["0.001", "0.01"])
def test_query_against_brute_force(spark, table):
    at = f"/root/testdata/sf{table}"
    ids = {}
    for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "source").collect():
        ids.setdefault(r.source, []).append(r.doc_id)
    weights = mixing.integer_weights({s: WEIGHTS.get(s, min(WEIGHTS.values())) for s in ids})
    want = set()
    for slot, (s, block) in enumerate(slow_schedule({s: -(-len(x) // 8) for s, x in ids.items()}, weights)):
        want |= {(d, s, block, slot, k) for k, d in enumerate(sorted(ids[s])[8 * block : 8 * block + 8])}
    got = [(r.doc_id, r.source, r.block, r.slot, r.offset) for r in op10_mix_sources(spark, at).collect()]
    assert len(got) == len(want) and set(got) == want


def test_short_periods_come_together():
    segments = list(mixing.plan({"a": 3_000_000, "b": 1_000_000}, {"a": 3, "b": 1}))
    assert len(segments) == -(-4_000_000 // mixing.UNIT) and sum(s[1] for s in segments) == 4_000_000
