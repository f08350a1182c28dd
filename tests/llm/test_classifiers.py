import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import licences, quality, toxicity
from skein.llm.queries import op4_quality_classifier, op9_toxicity

BIG = "/root/testdata/sf0.01"


def accuracy(spark, df, label):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = df.where("held_out").join(labels, "doc_id").collect()
    return sum(r.predicted == r.y for r in rows) / len(rows), len(rows)


def check_scores(rows, parts, part, cut):
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)


def test_quality_on_held_out_documents(spark):
    df = op4_quality_classifier(spark, BIG).cache()
    check_scores(df.collect(), 4, 2, 0.7)
    share, n = accuracy(spark, df, "quality")
    assert df.count() == 1000 and n > 50 and share > 0.88


def test_toxicity_on_held_out_documents(spark):
    df = op9_toxicity(spark, BIG).cache()
    check_scores(df.collect(), 5, 0, 0.5)
    share, n = accuracy(spark, df, "toxic")
    assert df.count() == 1000 and n > 50 and share > 0.9


def test_disguises_are_undone():
    texts = ["you are an idiot and a moron my friend", "the weather is fine and the sun is out", "what an idiotic thing", "loser and idiot", "we all like a good walk"] * 30
    model = toxicity.CharModel(toxicity.trigram_counts(texts))
    restorer = toxicity.Restorer(model)
    for seen, word in (("1d10t", "idiot"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n", "moron"), ("l0ser", "loser"), ("m*ron", "moron")):
        assert word in restorer.restored(seen)
    assert restorer.restored("plain") == ("plain",)
    assert "idiot" in restorer.tokens("oh i d i o t you")


def test_disguised_toxic_words_score_like_plain_ones():
    toxic = [(f"this is some text number {i} you stupid moron and idiot", 1) for i in range(60)]
    clean = [(f"this is some text number {i} with nothing bad in it at all", 0) for i in range(200)]
    counts = toxicity.trigram_counts([t for t, _ in toxic + clean])
    model = toxicity.ToxicityModel(counts, toxic + clean, {0: 200, 1: 60})
    s = model.score(["you 1d10t", "you m o r o n", "stuuuupid m0r0n", "a nice day", "", None, "\x00"])
    assert (s[:3] > 0.5).all() and (s[3:] < 0.5).all()


def test_classifiers_without_labels_rows_or_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (1, "")], "doc_id long, text string").withColumn("score", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for labels in (none, one):
            model = module.fit(docs, labels)
            assert all(0 <= r.score <= 1 for r in module.score(docs, model).collect()) and module.score(docs, model).count() == 3
            assert module.score(docs.limit(0), model).collect() == []


def test_quality_sizes_and_column(spark):
    good = [f"Some ordinary sentence number {i} about things, with commas and points." * 5 for i in range(80)]
    bad = [("JUNK!! " * 40 + str(i)) for i in range(80)]
    sample = [(t, 1) for t in good] + [(t, 0) for t in bad]
    model = quality.QualityModel(sample, {0: 80, 1: 80})
    s = model.score([good[70], bad[70]])
    assert s[0] > 0.7 > s[1]
    df = spark.createDataFrame([(good[0],), (bad[0],), (None,)], "text string")
    assert np.allclose([r.s for r in df.select(quality.score_column(model, F.col("text")).alias("s")).collect()], model.score([good[0], bad[0], None]))


def test_licences(spark):
    mit = licences.KNOWN[0][1]
    docs = [(1, "Copyright (c) 2020 A B\nAll rights reserved.\n" + mit.upper().replace("\n\n", "\n \n")), (2, mit + " and more"), (3, "text\n  ** Licenced under the Apache Licence, version 2.0 **\nReleased under the MIT License"), (None, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("licence", F.lit("x"))
    got = {r.doc_id: (r.text_licence, r.notice_licences) for r in licences.scan(df).collect()}
    assert got == {1: ("MIT", ""), 2: (None, ""), 3: (None, "Apache-2.0,MIT"), None: (None, ""), 4: (None, "")}
    plan = licences.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licences.scan(df.limit(0)).collect() == []


def test_long_licences_as_published(spark):
    """Texts of the system's own licence folder, reflowed and with another head, are found whole."""
    folder = Path("/usr/share/common-licenses")
    if not (folder / "GPL-3").exists():
        pytest.skip("no licence texts on this machine")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}
    texts = {f: (folder / f).read_text() for f in names}
    rows = [(i, f, "Copyright (C) 2031 Somebody\n" + t.replace("\n\n", "\n \n ").replace("license", "LICENCE")) for i, (f, t) in enumerate(texts.items())]
    rows += [(50, "Apache-2.0", texts["Apache-2.0"].split("END OF TERMS")[0]), (51, None, texts["GPL-3"] + "\nand one word"), (52, None, texts["MPL-2.0"][:-200])]
    rows += [rows[0], rows[0]]  # repeated rows stay
    df = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    got = sorted((r.doc_id, r.text_licence) for r in licences.scan(df).collect() if r.text_licence)
    assert got == sorted((i, names[f]) for i, f, _ in rows if f)


def toxicity_model():
    toxic = [(f"this is some text number {i} you stupid moron and idiot", 1) for i in range(60)]
    clean = [(f"this is some text number {i} with nothing bad in it at all, a fair day and a good walk", 0) for i in range(200)]
    return toxicity.ToxicityModel(toxicity.trigram_counts([t for t, _ in toxic + clean]), toxic + clean, {0: 200, 1: 60})


def test_long_disguises_score_like_short_ones():
    model = toxicity_model()
    plain = "with nothing bad in it "
    long = [
        " ".join((plain * 60 + "you idiot and moron").replace(" ", "")),
        ",".join(["day"] * 400 + ["idiot"]),
        ";".join(["walk"] * 400 + ["m0r0n", "day"]),
        ",".join(["walk"] * 90 + ["st*pid", "day"]),
        "m" + "o" * 500 + "ron",
        "_" * 9 + "i" + "d".join(["_" * 30] * 2) + "i____o____t",
        "_".join("nothingbadinitatall" * 4 + "idiot"),
        "1d10t" * 20,
        "moron" * 100,
    ]
    short = model.score(["idiot"])[0]
    assert [s > short - 1e-6 for s in model.score(long)] == [True] * len(long)
    clean = [" ".join((plain * 60).replace(" ", "")), ",".join(["day"] * 400), "w" + "a" * 500 + "lk", "walk" * 200]
    assert np.allclose(model.score(clean), model.score([""])[0]) and model.score([""])[0] < short - 0.1


def test_decoding_finds_the_likeliest_words():
    rng = np.random.default_rng(14)
    model = toxicity.CharModel(toxicity.trigram_counts(["".join(rng.choice(list("aeioulst "), size=300))] * 30))

    def brute(observed, best):
        """All readings of signs that don't repeat."""
        found = {"": 0.0}
        for sign in observed:
            letters = [(0.0, sign)] if sign.isalpha() else []
            letters += [(0.7, x) for x in toxicity.LEET.get(sign, "")] + ([] if sign.isalnum() else [(0.7, "")])
            grown = {}
            for word, c in found.items():
                for extra, x in letters:
                    grown[word + x] = min(c + extra, grown.get(word + x, np.inf))
            found = grown
        cost = {}
        for word, c in found.items():
            k = [0, 0, *(toxicity._CLASS[x] for x in word), 0]
            cost[word] = c + sum(float(model.cost[x]) for x in zip(k, k[1:], k[2:], strict=False))
        return sorted(cost[w] for w in cost if w)[:best], cost

    for observed in ("*!*|*!", "s*t*|*1*", "!*1*!*|*", "a*+*s*t*!"):
        want, cost = brute(observed, 3)
        assert np.allclose([cost[w] for w in model.decode(observed)], want)


def test_doubled_letters_and_edge_signs_are_undone():
    texts = ["you are an idiot and a moron my friend", "the weather is fine and the sun is out", "loser and idiot", "we all like a good walk"] * 30
    restorer = toxicity.Restorer(toxicity.CharModel(toxicity.trigram_counts(texts)))
    for seen, word in (("iddiiot", "idiot"), ("mooron", "moron"), ("!diot", "idiot"), ("|oser", "loser"), ("'!d!ot'", "idiot"), ("loser!", "loser"), ("**loser**", "loser")):
        assert any(word in restorer.restored(t) for t in restorer.tokens(f"hey {seen} you")), seen
    model = toxicity_model()
    assert np.allclose(model.score(["!diot", "iddiiot", "idiot!", "idiot idiot! *idiot*"]), model.score(["idiot"])[0])


def test_wide_gaps_and_many_scores():
    model = toxicity_model()
    short = model.score(["idiot"])[0]
    assert (model.score(["you i  d  i  o  t", "i - d - i - o - t", "i..d..i..o..t"]) > short - 1e-6).all()
    assert model.score(["a  nice   day  to  go"])[0] < short - 0.1


def test_very_long_texts_are_read_to_their_end():
    model = toxicity_model()
    plain = "with nothing bad in it at all " * 100_000
    clean, toxic = model.score([plain, plain + "you 1d10t and m o r o n"])
    assert toxic > 0.5 > clean
    good = [f"Some ordinary sentence number {i} about things, with commas and points." * 5 for i in range(80)]
    bad = [("JUNK!! " * 40 + str(i)) for i in range(80)]
    sizes = quality.Sizes(quality.train_dictionary([t.encode() for t in good]), quality.train_dictionary([t.encode() for t in bad]))
    ends = [sizes.features("".join(good) * 50 + "".join(x) * 100)[0] for x in (good, bad)]
    assert ends[0] > 0.01 + ends[1]  # what stands at the end counts
