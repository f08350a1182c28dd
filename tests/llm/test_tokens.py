import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skein.llm import tokens

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokens.TextEncoder(PATH, cache_entries=40)


def same(texts):
    got = ENCODER.encode(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_equals_the_library():
    odd = ["", None, " ", "  a  b\n c", "don't I'll 'twas", "a\x1cb c", "tab\t d", "ĿĿ ʼn ßß. ñ!", "a.b c,d e!? f", "1st x2 y²", " lead", "trail ", "日本 語", "é é́ x", "<|endoftext|> x", "a b  c  d", "x\x00 y", "w.\nUp. q!\n z\n", "a\n\nb c", "A.\nb\nc"]
    same(odd)
    for _ in range(3):
        same(odd * 2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab. ,\n\t'!é1  x語")), max_size=40), max_size=5))
def test_encoder_on_odd_spaces(texts):
    same(texts)


def test_encoder_on_real_texts(spark, sf):
    same([r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()])


def test_a_word_is_encoded_once_whatever_closes_it():
    words = [a + b for a in ("stone", "Größe", "the", "19", "éa") for b in ("", "r", "ly", "77", "ß")]
    closings = ["", ".", ",", "***", ".$$$", "%)", "\n", ".\n", "!\n\n"]
    rng = random.Random(1)
    texts = ["".join(w + c + " " * (not c.endswith("\n")) for w in rng.sample(words, 25) for c in rng.sample(closings, 2)) + "end" for _ in range(40)]
    texts += [" ".join(w + c for w in words for c in closings if "\n" not in c), None, ""]
    encoder = tokens.TextEncoder(PATH)
    got = encoder.encode(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]
    mixed = sum(not w.isalpha() and not w.isdigit() for w in words)  # of letters and digits: not one pre-token, kept with what closes them
    assert len(encoder.young) <= 2 * (len(words) - mixed) + 2 * mixed * len(closings) + len(closings) + 5


def test_long_pieces_are_not_kept():
    texts = ["語" * 500 + " " + "x" * 65 + " " + "y" * 64 + ". z", "-" * 70 + "\n" + "é" * 64 + "-" * 63 + " " + "語z" * 40]
    encoder = tokens.TextEncoder(PATH)
    got = encoder.encode(pa.array(texts))
    assert [g.tolist() for g in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, encoder.young)) == 64


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZ1\n\n\t\r\x1c\x85\u3000 .$'(\x00²ª×ɐ")), max_size=30), max_size=5))
def test_encoder_on_odd_feeds_and_signs(texts):
    same(texts)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000, 5000])
def test_coder_round_trip_and_checkpoints(n):
    rng = random.Random(n)
    ids = np.array([min(int(rng.expovariate(0.01)), 3000) for _ in range(n)], np.uint16)
    freq = tokens.shared_frequencies({int(i): int(c) for i, c in zip(*np.unique(ids, return_counts=True), strict=True)})
    assert freq.sum() == 1 << tokens.BITS and (freq[ids] > 0).all()
    coder = tokens.Coder(freq)
    block = coder.encode(ids, lanes=8, check_steps=5)
    assert coder.decode(block).tolist() == ids.tolist()
    lanes = max(1, min(8, n // 64))
    parts = -(-(-(-n // lanes)) // 5)
    assert np.concatenate([coder.decode(block, p) for p in range(parts)]).tolist() == ids.tolist()
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(block[:-6] + bytes([block[-6] ^ 1]) + block[-5:])


def want(rows):
    start, out = 0, []
    for d, t in rows:
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_the_library(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokens.write_tokens(docs, str(tmp_path / "t"), PATH, block_tokens=3000)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_digests(spark, str(tmp_path / "t")).collect())
    assert got == want(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))
    whole = tokens.read_tokens(spark, str(tmp_path / "t"))
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == g[3] for r, g in zip(whole.orderBy("doc_id").collect(), got, strict=True))


def test_nulls_repeats_and_no_rows(spark, tmp_path):
    rows = [(3, "b"), (None, "n"), (1, None), (2, ""), (3, "b"), (5, "long " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("start", F.lit(1))
    tokens.write_tokens(df, str(tmp_path / "a"), PATH)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.read_digests(spark, str(tmp_path / "a")).collect()))
    assert got == [(s, d, n, c) for d, s, n, c in want([(None, "n"), (1, None), (2, ""), (3, "b"), (3, "b"), rows[-1]])]
    tokens.write_tokens(df.limit(0), str(tmp_path / "b"), PATH)
    assert tokens.read_digests(spark, str(tmp_path / "b")).collect() == []
