"""Quality classifier by compression: dictionaries of good and of bad text, their size difference calibrated.

The normalised difference of the compressed sizes carries the score. Two more inputs weigh it, without
a threshold anywhere: the share n / (n + HALF) of a text of n bytes, since a short text's difference
says less, and the plain compression ratio times that share, since what repeats itself compresses
well with either dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import arrow_column, fold, map_arrow
from skein.llm.fitting import Logistic, class_weights, labelled_sample

CHUNK, DICT_BYTES, LEVEL, HALF = 4096, 1 << 16, 3, 400


def _chunks(raw: bytes) -> list[bytes]:
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


def train_dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary, or the raw texts' first bytes where they are too few to train on."""
    parts = [c for t in texts for c in _chunks(t) if len(c) >= 64]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[:size]


class Sizes:
    """Compressed sizes of a text, in chunks, with the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.compress = []
        for d in (good, bad, b""):
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if d:
                data = zstandard.ZstdCompressionDict(d)
                data.precompute_compress(level=LEVEL)
                options["dict_data"] = data
            self.compress.append(zstandard.ZstdCompressor(**options).compress)

    def features(self, text: str | None) -> list[float]:
        """Normalised difference, the same and the plain ratio by the text's share of certainty, and that share."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        g, b, o = (sum(len(f(c)) for c in _chunks(raw)) for f in self.compress)
        d, r, share = (b - g) / max(o, 1), o / max(len(raw), 1), len(raw) / (len(raw) + HALF)
        return [d, d * share, share, min(r, 1.5) * share]


class QualityModel:
    """Two dictionaries from one part of a bounded labelled sample, calibrated on the other part."""

    def __init__(self, sample: list[tuple[str, int]], counts: dict[int, int]):
        raw = [(t.encode("utf-8", "surrogatepass"), y) for t, y in sample]
        half = [len([1 for _, y in raw if y == c]) // 2 for c in (0, 1)]
        seen, held, books = [0, 0], [], ([], [])
        for (t, y), (text, _) in zip(raw, sample, strict=True):
            seen[y] += 1
            if seen[y] <= half[y]:
                books[y].append(t)
            else:
                held.append((text, y))
        self.good, self.bad = train_dictionary(books[1]), train_dictionary(books[0])
        self._sizes: Sizes | None = Sizes(self.good, self.bad)
        y = np.array([y for _, y in held], float)
        x = np.array([self._sizes.features(t) for t, _ in held]).reshape(-1, 4)
        self.logistic = Logistic(x, y, class_weights(y, counts))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_sizes": None}

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self._sizes is None:
            self._sizes = Sizes(self.good, self.bad)
        if not texts:
            return np.zeros(0)
        return self.logistic(np.array([self._sizes.features(t) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2, per_class: int = 3000, max_bytes: int = 1 << 16, doc_id: str = "doc_id", text: str = "text") -> QualityModel:
    """A model from at most per_class labelled rows of each class, each of at most max_bytes, outside the held-out fold."""
    sample, counts = labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), parts) != part, per_class, max_bytes, doc_id, text)
    return QualityModel(sample, counts)


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: (doc_id long, score double), the probability of label 1.

    Whole texts of any length are scored, in chunks, in one pass without a shuffle. Null and empty texts take the score of an
    empty text; null ids and repeated rows stay; extra columns are ignored; no rows give no rows.
    With labels of one class only, all scores lean to it; without labels they are one half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "doc_id long, score double", "quality")


def score_column(model: QualityModel, text: Column) -> Column:
    """The score as a column, never null; a filter on it needs no shuffle. Nulls and repeated rows as in score()."""
    return arrow_column(lambda texts: pa.array(model.score(texts.to_pylist()), pa.float64()), "double", "quality", text.cast("string"))
