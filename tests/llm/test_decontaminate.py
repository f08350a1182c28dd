import random

from pyspark.sql import functions as F

from skein.llm import decontaminate as dc


def slow_distance(pattern, text):
    prev = list(range(len(pattern) + 1))
    best = prev[-1]
    for c in text:
        cur = [0]
        for i, p in enumerate(pattern, 1):
            cur.append(min(prev[i] + 1, cur[-1] + 1, prev[i - 1] + (p != c)))
        prev = cur
        best = min(best, prev[-1])
    return best


def test_myers_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert dc.Myers(p).best(t)[0] == slow_distance(p, t)


def edited(rng, s, k):
    for _ in range(k):
        i = rng.randrange(len(s))
        s = rng.choice([s[:i] + s[i + 1 :], s[:i] + "q" + s[i:], s[:i] + "q" + s[i + 1 :]])
    return s


def test_matcher_finds_all_within_budget():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 30)))) for i in range(12)]
    matcher = dc.EditMatcher(items, 0.1)
    for _ in range(60):
        parts = [" ".join(word() for _ in range(20))]
        for i in rng.sample(range(12), 2):
            parts += [edited(rng, items[i][1], rng.randint(0, 9)).upper(), " ".join(word() for _ in range(9))]
        text = "\n ".join(parts)
        want = {(i, d) for i, t in items if (d := slow_distance(dc.normalise(t), dc.normalise(text))) <= int(0.1 * len(dc.normalise(t)))}
        assert {(i, d) for i, d, _ in matcher.matches(text)} == want


def test_tables(spark):
    passage = "The quick brown fox jumps over the lazy dog while it rains"
    docs = spark.createDataFrame([(1, "x " + passage + " y"), (2, None), (3, ""), (None, passage.lower()), (1, "clean"), (4, passage.replace("quick", "quack").replace(" ", "\n"))], "doc_id long, text string").withColumn("item_id", F.lit("z"))
    bench = spark.createDataFrame([(7, passage), (8, None), (9, "short"), (7, passage)], "item_id long, text string").withColumn("doc_id", F.lit(0))
    for block_chars in (4_000_000, 40):
        got = sorted(((r.doc_id, r.item_id, r.distance) for r in dc.find_leaks(docs, bench, block_chars=block_chars).collect()), key=str)
        assert got == sorted([(1, 7, 0), (1, 7, 0), (None, 7, 0), (None, 7, 0), (4, 7, 1), (4, 7, 1)], key=str)
        kept = docs.where(~dc.is_leaked(bench, F.col("text"), block_chars=block_chars))
        assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "2", "3"]
    assert dc.find_leaks(docs.limit(0), bench).collect() == [] and dc.find_leaks(docs, bench.limit(0)).collect() == []


def test_short_items_are_whole_words():
    matcher = dc.EditMatcher([(1, "Red fox"), (2, ""), (3, "7"), (4, "é b")])
    found = lambda t: sorted(i for i, _, _ in matcher.matches(t))
    assert found("a red  FOX, 17 or 77") == [1] and found("7") == [3] and found("bored fox and red foxes, é bb") == [] and found("x é\nb 7.") == [3, 4]
    assert matcher.matches("red fox red fox") == [(1, 0, 7)]


def test_query_against_brute_force(spark, sf):
    """Every item in every text of the whole table, by dynamic programming over all ends at once."""
    import numpy as np

    from skein.llm.queries import op6_benchmark_decontamination

    items = [(r.item_id, dc.normalise(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = dc.normalise(r.text or "")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for item_id, item in items:
            row = np.zeros(len(text) + 1, np.int64)
            steps = np.arange(len(row))
            for i, c in enumerate(item, 1):
                new = np.r_[i, np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))]
                row = np.minimum.accumulate(new - steps) + steps
            if row.min() <= int(dc.ERROR_RATE * len(item)):
                want.add((r.doc_id, item_id, int(row.min())))
    got = [(r.doc_id, r.item_id, r.distance) for r in op6_benchmark_decontamination(spark, sf).collect()]
    assert want and len(got) == len(set(got)) and set(got) == want
