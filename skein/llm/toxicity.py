"""Toxicity: Viterbi decoding of disguised words under a character model, then a word score of the restored text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import fold, map_arrow
from skein.llm.fitting import Logistic, class_weights, labelled_sample

#: What a written sign may stand for, besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou", "#": "h"}
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåçèéêëìíîïñòóôöõùúûüýßæœ"
_CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_N = len(LETTERS) + 1
_EDGE = " \t\n\r.,;:?\"'“”„‘’«»()[]{}<>-–—_/\\!|*#%&~^`=+"
_STRIP = _EDGE.replace("+", "").replace("(", "")
_OUTER = "".join(c for c in _STRIP if c not in LEET)
_REPEAT = re.compile(r"([^\W\d_])\1")
_SPACED = re.compile(r"(?<!\S)\S(?:[ .\-_*/]{1,3}\S){3,}(?!\S)")
_MIXED = re.compile(r"[^\W\d_].*[0-9@$!|+€(*#]|[0-9@$!|+€(*#].*[^\W\d_]")
_SEPARATED = re.compile(r"^(?:\w[.\-_*/]){2,}\w$")
_NO_WORD = re.compile(r"[^\w]+")
_SEPARATOR = re.compile(r"[ .\-_*/]")
_LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_GAP = re.compile(r"(?:[^\w\s@$!|+€(*#]|_){2,}")
_PLAIN_GAP = re.compile(r"[^\w@$!|+€(*#]+")
#: Signs decoded at once; longer tokens are decoded in pieces that overlap by half.
PIECE = 40
#: Longer tokens are restored anew each time instead of being kept.
KEPT = 100
_TABLE = np.zeros(0x250, np.int64)
for _c, _i in _CLASS.items():
    for _x in {_c, _c.upper()}:
        if len(_x) == 1 and ord(_x) < len(_TABLE):
            _TABLE[ord(_x)] = _i


def trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """Counts of character trigrams; every sign that isn't a letter of LETTERS counts as a space."""
    total = np.zeros(_N**3, np.int64)
    for t in texts:
        codes = np.frombuffer(f"  {t}  ".encode("utf-32-le", "surrogatepass"), np.uint32)
        k = _TABLE[np.minimum(codes, len(_TABLE) - 1)]
        total += np.bincount((k[:-2] * _N + k[1:-1]) * _N + k[2:], minlength=_N**3) if len(k) > 4096 else 0
        if len(k) <= 4096:
            np.add.at(total, (k[:-2] * _N + k[1:-1]) * _N + k[2:], 1)
    return total


class CharModel:
    """Interpolated character trigrams from counts."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(_N, _N, _N).astype(np.float64)
        c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
        p1 = (c1 + 1) / (c1.sum() + _N)
        p2 = (c2 + 4 * p1) / (c2.sum(axis=1, keepdims=True) + 4)
        self.cost = -np.log((c3 + 4 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 4)).astype(np.float32)
        self._costs = self.cost.tolist()

    def decode(self, observed: str, best: int = 3) -> list[str]:
        """The likeliest words behind a disguised one: signs stand for letters, runs shrink, separators go.

        Exact Viterbi decoding: a state is the last two letters and keeps its `best` cheapest words.
        """
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", observed, re.DOTALL)]
        costs = self._costs
        states: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
        for sign, n in runs:
            options: list[tuple[float, str]] = []
            for letter in ([sign] if sign in _CLASS else []) + list(LEET.get(sign, "")):
                change = 0.0 if letter == sign else 0.7
                options += [(change + (0.0 if k == n else 0.5), letter * k) for k in {1, min(n, 2)}]
            if not sign.isalnum():
                options.append((0.7, ""))
            if not options:
                options.append((0.0, ""))
            grown: dict[tuple[int, int], dict[str, float]] = {}
            for (a, b), paths in states.items():
                for extra, letters in options:
                    x, y = a, b
                    for letter in letters:
                        z = _CLASS[letter]
                        extra += costs[x][y][z]
                        x, y = y, z
                    words = grown.setdefault((x, y), {})
                    for cost, word in paths:
                        w, c = word + letters, cost + extra
                        if c < words.get(w, math.inf):
                            words[w] = c
            states = {at: sorted((c, w) for w, c in words.items())[:best] for at, words in grown.items()}
        ended = sorted((c + costs[a][b][0], w) for (a, b), paths in states.items() for c, w in paths if w)
        return [w for _, w in ended[:best]]


def squeezed(seen: str) -> str:
    """Without what decoding drops anyway: runs of one sign shrink to three, gaps of several separators to their first."""
    return _GAP.sub(lambda m: m[0][0], _LONG_RUN.sub(r"\1\1\1", seen))


def pieces(seen: str) -> Iterator[str]:
    """The whole of a short token, overlapping pieces of a long one."""
    for at in range(0, max(1, len(seen) - PIECE // 2), PIECE // 2):
        yield seen[at : at + PIECE]


def windows(run: str) -> Iterator[str]:
    """Each stretch of 4 to 12 signs."""
    for i in range(max(1, len(run) - 3)):
        for n in range(4, 13):
            if i + n <= len(run) or (i == 0 and n == 4):
                yield run[i : i + n]


def grams(word: str) -> Iterator[str]:
    """The word and its beginnings of four to nine letters."""
    yield "=" + word
    for n in range(4, 10):
        if len(word) > n:
            yield word[:n]


class Restorer:
    """Words of a text with disguises undone; decoded words are kept in a bounded cache."""

    def __init__(self, model: CharModel, limit: int = 200_000):
        self.model, self.limit, self.cache = model, limit, {}

    def restored(self, token: str) -> tuple[str, ...]:
        """Hypotheses for one token in lower case, without its edge signs and with those that may stand for letters; plain words stand for themselves."""
        if token.isalpha() and not _REPEAT.search(token):
            return (token,)
        if len(token) > KEPT:
            return self._restore(token)
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            found = self.cache[token] = self._restore(token)
        return found

    def _restore(self, token: str) -> tuple[str, ...]:
        bare = token.strip(_STRIP)
        out = dict.fromkeys(w for w in (bare, *(self.restored(bare) if bare != token else ()), *self._decoded(token)) if w)
        splits = [_NO_WORD] if len(token) <= PIECE else [_PLAIN_GAP, _NO_WORD]
        for part in dict.fromkeys(p for by in splits for p in by.split(token) if p and p != token):
            out |= dict.fromkeys(self.restored(part))
        return tuple(out)

    def _decoded(self, seen: str) -> Iterator[str]:
        short = squeezed(seen)
        separated = _SEPARATED.match(short)
        if separated and len(short) > PIECE:
            for w in windows(_SEPARATOR.sub("", short)):
                yield from self.restored(w)
            return
        for p in pieces(short):
            if separated or _REPEAT.search(p) or _MIXED.search(p):
                yield from self.model.decode(p)

    def tokens(self, text: str) -> Iterator[str]:
        """Lower-case tokens without edge signs other than those that may stand for letters, and stretches of runs of single signs joined; those of runs may come again."""
        low = text.lower()
        yield from {t.strip(_OUTER) for t in set(low.split())} - {""}
        for m in _SPACED.finditer(low):
            yield from windows(_SEPARATOR.sub("", m[0]))


class Words:
    """Log-odds of words and their beginnings, cautious about rare ones: the lower bound of the toxic share among balanced classes."""

    def __init__(self, sample: list[tuple[set[str], int]], z: float = 1.64):
        pos, neg = Counter(), Counter()
        n = [max(1, sum(1 for _, y in sample if y == c)) for c in (0, 1)]
        for words, y in sample:
            if y:
                pos.update({g for w in words for g in grams(w)})
        pos = Counter({g: p for g, p in pos.items() if p >= 3})
        for words, y in sample:
            if not y:
                neg.update({g for w in words for g in grams(w) if g in pos})
        self.weight: dict[str, float] = {}
        for g, p in pos.items():
            a, b = p, neg.get(g, 0) * n[1] / n[0]
            t = a + b
            share = a / t
            low = (share + z * z / (2 * t) - z * math.sqrt(share * (1 - share) / t + z * z / (4 * t * t))) / (1 + z * z / t)
            if low > 0.6:
                self.weight[g] = math.log(low / (1 - low))

    def of(self, word: str) -> float:
        """The highest weight of its grams; weights are positive."""
        get = self.weight.get
        best = get("=" + word, 0.0)
        for n in range(4, min(10, len(word))):
            found = get(word[:n], 0.0)
            if found > best:
                best = found
        return best


class ToxicityModel:
    """Fitted on a bounded sample; counts of the character model cover all documents."""

    def __init__(self, counts: np.ndarray, sample: list[tuple[str, int]], label_counts: dict[int, int]):
        self.counts = counts
        self._restorer = Restorer(CharModel(counts))
        words = [(self._words(t), y) for t, y in sample]
        self.words = Words(words)
        self._cache: dict[str, float] = {}
        y = np.array([y for _, y in sample], float)
        x = np.array([self._features(w) for w, _ in words]).reshape(-1, 3)
        self.logistic = Logistic(x, y, class_weights(y, label_counts))

    def __getstate__(self) -> dict:
        return {"counts": self.counts, "words": self.words, "logistic": self.logistic}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._restorer, self._cache = Restorer(CharModel(self.counts)), {}

    def _words(self, text: str | None) -> set[str]:
        out: set[str] = set()
        for token in self._restorer.tokens(text or ""):
            out.update(self._restorer.restored(token))
        return out

    def _of(self, token: str) -> float:
        found = self._cache.get(token)
        if found is None:
            found = max(map(self.words.of, self._restorer.restored(token)), default=0.0)
            if len(token) <= KEPT:
                if len(self._cache) >= 400_000:
                    self._cache.clear()
                self._cache[token] = found
        return found

    def _features(self, tokens: Iterable[str]) -> list[float]:
        """The highest word score, and sums of all of them that fall with their rank, so that a long text doesn't add up to a toxic one."""
        found: dict[str, float] = {}
        for t in tokens:
            if s := self._of(t):
                bare = t.strip(_STRIP)
                found[bare] = max(s, found.get(bare, 0.0))
        scores = sorted(found.values(), reverse=True)
        return [scores[0] if scores else 0.0, sum(s / k for k, s in enumerate(scores, 1)), sum(s / k**0.5 for k, s in enumerate(scores, 1))]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.logistic(np.array([self._features(self._restorer.tokens(t or "")) for t in texts]))


def corpus_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Character trigram counts over all texts: partial counts, summed by trigram; at most the alphabet cubed reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_N**3, np.int64)
        for b in batches:
            col = b.column(0).drop_null()
            for at in range(0, len(col), 256):
                total += trigram_counts(["  ".join(col.slice(at, 256).to_pylist())])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    rows = map_arrow(docs.select(F.col(text).cast("string")), run, "gram int, n long", "toxicity").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_N**3, np.int64)
    for r in rows:
        counts[r.gram] = r.n
    return counts


def fit(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, per_class: int = 2000, max_bytes: int = 1 << 15, doc_id: str = "doc_id", text: str = "text") -> ToxicityModel:
    """A model from at most per_class labelled rows of each class outside the held-out fold."""
    sample, counts = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), parts) != part, per_class, max_bytes, doc_id, text)
    return ToxicityModel(corpus_counts(docs, text), sample, counts)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: (doc_id long, score double).

    Whole texts are scored in one pass without a shuffle. Null and empty texts hold no word and take
    the score of such a text; null ids and repeated rows stay; extra columns are ignored; no rows
    give no rows. Without toxic labels all scores are low.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1).to_pylist()))], ["doc_id", "score"])

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "doc_id long, score double", "toxicity")
