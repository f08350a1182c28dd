import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from skein.llm import suffixes
from skein.llm.queries import op5_suffix_dedup


def slow_removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def corpus(rng, n, length):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(length // 2)) for _ in range(4)]
    texts = ["", "x" * (length - 1), "y" * (4 * length), "ab " * (2 * length), passages[0], passages[0]]
    for _ in range(n):
        body = [word() for _ in range(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            body.insert(rng.randint(0, len(body)), p[a : a + rng.randint(length // 2, 3 * length)])
        texts.append(" ".join(body))
        if rng.random() < 0.3:  # a near copy
            t = list(texts[-1])
            for _ in range(rng.randint(1, 4)):
                if t:
                    t[rng.randrange(len(t))] = "#"
            texts.append("".join(t))
    return texts


def test_deep_shallow_order_and_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        head = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90)))
        strings = [head[: rng.randint(0, len(head))] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(1, 40))]
        strings += strings[:3]
        order, shared = suffixes.deep_shallow_sort(strings, 0, rng.choice([8, 16, 32]))
        ranked = [strings[i] for i in order]
        assert ranked == sorted(strings) and sorted(order) == list(range(len(strings)))
        for k in range(1, len(order)):
            a, b = ranked[k - 1], ranked[k]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert shared[k] == n


def test_anchors_do_not_depend_on_segments():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(3000)) + b"z" * 700, b"", bytes(rng.choice(b"ab ") for _ in range(900))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    begin = end - [len(t) for t in texts]
    whole = suffixes.byte_windows(40).anchors(data, begin, end)
    for segment in (37, 200, 1999):
        for a, b in zip(whole, suffixes.byte_windows(40).anchors(data, begin, end, segment), strict=True):
            assert a.tolist() == b.tolist()
    alone = suffixes.byte_windows(40).anchors(np.frombuffer(texts[2], np.uint8), np.array([0]), np.array([900]))
    assert [x[whole[0] == 2].tolist() for x in whole[1:]] == [x.tolist() for x in alone[1:]]
    starts, codes = suffixes.word_codes(data)
    for segment in (5, 64, 2000):
        for a, b in zip((starts, codes), suffixes.word_codes(data, segment), strict=True):
            assert a.tolist() == b.tolist()
    assert len(codes) == len(data.tobytes().split())


def slow_passages(rows, words):
    """Words of each text covered by passages of so many words that a different row has too."""
    split = [(t or "").encode().split() for _, t, *_ in rows]
    where = defaultdict(set)
    for r, w in zip(rows, split, strict=True):
        for i in range(len(w) - words + 1):
            where[tuple(w[i : i + words])].add(r[:2])
    out = []
    for w in split:
        held = set()
        for i in range(len(w) - words + 1):
            if len(where[tuple(w[i : i + words])]) > 1:
                held |= set(range(i, i + words))
        out.append(len(held))
    return out


@pytest.mark.parametrize(("length", "hot", "passage"), [(40, 20_000, 8), (41, 3, 5), (16, 5, 3), (400, 100_000, 50)])
def test_against_brute_force(spark, length, hot, passage):
    texts = corpus(random.Random(length), 60, length)
    texts += ["\n".join(t.split()) for t in texts[5:25]]  # the same words, other bytes
    rows = [(i if i % 7 else None, t if t else None, "x") for i, t in enumerate(texts)]
    rows.append(rows[-1])
    texts.append(texts[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string, raw string")
    got = suffixes.remove_repeats(df, length=length, hot=hot, passage=passage).collect()
    want = slow_removed([t.encode() for t in texts], length)
    said = slow_passages(rows, passage)
    assert any(said) and any(w[1] for w in want)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.n_passage_words) for r in got) == Counter((r[0], *w, n) for r, w, n in zip(rows, want, said, strict=True))


def test_query_against_brute_force(spark, sf):
    """The registered query at its own length over the whole table."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = slow_removed([(t or "").encode() for _, t in rows], 400)
    said = slow_passages(rows, 50)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_words) for r in op5_suffix_dedup(spark, sf).collect()}
    assert got == {r[0]: (*w[:3], hashlib.sha256(w[3]).hexdigest(), n) for r, w, n in zip(rows, want, said, strict=True)}


def test_chunks_combine_copies():
    """Many copies of one passage leave one row for each chunk that goes on; all others are settled at once."""
    n = 1_000_000
    a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    doc = np.arange(n)
    state = suffixes.combined([a, b, doc, doc, np.zeros(n, np.int64)])[-1]
    assert (state == suffixes.SEVERAL).sum() == 1 and (state == suffixes.DONE).sum() == n - 1
    state = suffixes.combined([a + np.uint64(1), b, doc * 0, doc * 0, np.zeros(n, np.int64)])[-1]
    assert (state == suffixes.OPEN).all()  # words of one row only


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(df).collect() == []
