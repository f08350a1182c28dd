import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from skein.llm import decontaminate, quality
from test_simhash import slow_fingerprint, slow_roots


def test_pipeline_against_brute_force(spark, sf):
    """Every stage by hand on the driver; the mixed order is taken from the order of the token starts and held against the weights."""
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [r for r, s in zip(rows, model.score([r[1] for r in rows]), strict=True) if s >= 0.7]
    prints = {r[0]: slow_fingerprint(r[1]) for r in rows}
    roots = slow_roots(prints.values())
    first = {}
    for d in sorted(prints):
        first.setdefault(roots[prints[d]], d)
    rows = [r for r in rows if r[0] in set(first.values())]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    matcher = decontaminate.EditMatcher(items)
    kept = {r[0]: r for r in rows if not matcher.matches(r[1])}
    assert len(kept) < len(rows)
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = sorted(cp.run(spark, sf).collect(), key=lambda r: r.start)
    assert sorted(r.doc_id for r in got) == sorted(kept)
    at = 0
    for r in got:
        ids = [*library.encode(kept[r.doc_id][1], add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    for s in {r[2] for r in rows}:
        own = [r.doc_id for r in got if kept[r.doc_id][2] == s]
        assert own == sorted(own)
    sources = [kept[r.doc_id][2] for r in got]
    assert sources != sorted(sources) and [r.doc_id for r in got] != sorted(kept)


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] and 4 <= len(cp.STAGES) <= 5
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).collect() == []


def test_stages_with_nulls_repeats_long_texts_and_clashing_columns(spark, sf):
    long = " ".join(f"word{i % 997} and so on" for i in range(60_000))
    rows = [(1, long, "en", "a", len(long)), (2, None, None, None, None), (None, "no id", "en", "a", 5), (None, None, None, None, None), (3, "", "en", "b", 0), (4, "same words here again", "en", "b", 21), (4, "same words here again", "en", "b", 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("score", "slot", "fp", "component_id", "block", "root", "ids"):
        docs = docs.withColumn(c, docs["n_chars"].cast("string"))
    want = {"quality classifier": None, "SimHash near-dedup": 4, "benchmark decontamination": 7, "mixing sources to target weights": 7}
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, sf)
        n = len(got.collect())
        assert got.columns == docs.columns and (want[name] is None or n == want[name]), name
    got = cp.token_stage(spark, docs, sf).collect()
    assert len(got) == len(rows) and sorted(r.start for r in got)[0] == 0 and sum(r.n_tokens == 1 for r in got) == 3
