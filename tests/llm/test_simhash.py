import random

import xxhash
from pyspark.sql import functions as F

from skein.llm import graph, simhash


def slow_fingerprint(text):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_roots(fps, radius=3):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint_matches_definition():
    rng = random.Random(3)
    texts = ["", None, " \t\n", "One", "ONE two", "Ünï ÀB c d\x0be", "a b c " * 400]
    texts += [" ".join(rng.choice("ab Cd é 語 xyz".split()) for _ in range(n)) for n in range(1, 700, 37)]
    for t in texts:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_links_join_all_pairs_within_three_bits(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)] + [0]
    for f in list(fps[:40]):
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
            fps.append(f)
    for start in range(0, 64, 16):  # three bits in one block, and a hot ball
        f = rng.getrandbits(64)
        fps += [f, f ^ (0b1011 << start)]
    hot = rng.getrandbits(64)
    fps += [hot ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)][::7]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in graph.components(simhash.links(df)).collect()}
    want = slow_roots(fps)
    groups = lambda m: {frozenset(k for k in fps if m.get(k, k) == r) for r in {m.get(k, k) for k in fps}}
    assert groups(got) == groups(want)


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    roots = slow_roots([slow_fingerprint(r.text) for r in rows])
    low = {}
    for r in rows:
        k = roots[slow_fingerprint(r.text)]
        low[k] = min(low.get(k, r.doc_id), r.doc_id)
    want = sorted((r.doc_id, slow_fingerprint(r.text), low[roots[slow_fingerprint(r.text)]]) for r in rows)
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b c d", "z"), (5, "a b c d", "z"), (5, "a b c d", "z"), (None, "only here now", "q"), (None, "only here now", "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").withColumn("fp", F.lit(1.5))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, 5), (5, 5), (5, 5), (None, None), (None, None)], key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "5", "None"]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200}


def test_rows_that_share_an_id_keep_their_components(spark):
    far = ["alpha beta gamma delta epsilon", "one two three four five six", "rot grün blau gelb weiß"]
    rows = [(1, far[0]), (1, far[1]), (2, far[1]), (2, far[0]), (3, far[2]), (3, far[2]), (None, far[2]), (None, "no id at all here"), (None, "no id at all here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(1, far[0]), (1, far[1]), (3, far[2]), (None, "no id at all here")], key=str)


def test_rows_without_ids_leave_one_of_each_component(spark):
    text = " ".join(f"word{i}" for i in range(3000))
    near = text.replace("word7 ", "word8 ")
    a, b = simhash.fingerprint(text), simhash.fingerprint(near)
    assert 0 < (a ^ b).bit_count() <= 3
    df = spark.createDataFrame([(None, text), (None, near)], "doc_id long, text string")
    assert len(simhash.keep_one(df).collect()) == 1
