"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category sees the words of the text and
the probabilities that the models before it gave. While training, those probabilities are
out-of-fold: a row's come from models that were fitted without it, so later models meet the same
quality of input as they will on new text. The last category decides.

Only training is bounded (``TRAIN_ROWS`` labelled rows, picked by a hash of the text); scoring reads
every whole text inside its row, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType

from .common import _BYTE_CODES, Words, give_back, labelled_sample, mix, powers, tidy, with_columns, word_chunks

SEEN_IN = 3  # training rows a word must occur in to carry weight
SIGNIFICANT = 3.5  # standard deviations from chance at which a word's rows tell of a category
TRAIN_ROWS = 6_000
FOLDS = 5
STEMS = (4, 5, 6)  # bytes of a word's beginning that are features of their own, for inflected forms
DECISION = 0.5
# Earlier categories: kinds of abuse, marked in labelled toxic rows by words of these lists.
SEEDS = {
    "contempt": ("disgusting", "pathetic", "worthless", "useless", "ridiculous", "shameful"),
    "insult": ("idiot", "moron", "stupid", "loser", "clown", "fool", "dumb", "imbecile"),
    "degradation": ("scum", "trash", "garbage", "filth", "vermin", "pig", "rat"),
}
LAST = "toxic"


class Linear(NamedTuple):
    weights: np.ndarray  # one per word of the vocabulary
    earlier: np.ndarray  # one per category before
    bias: float


class Sparse(NamedTuple):
    """Rows of distinct words (hashes or places in a vocabulary): row i has ``at[cut[i]:cut[i+1]]``."""

    at: np.ndarray
    cut: np.ndarray

    def rows(self, wanted: np.ndarray) -> "Sparse":
        sizes = np.diff(self.cut)[wanted]
        cut = np.concatenate(([0], np.cumsum(sizes)))
        place = np.arange(cut[-1]) - np.repeat(cut[:-1], sizes) + np.repeat(self.cut[:-1][wanted], sizes)
        return Sparse(self.at[place], cut)

    def within(self, vocabulary: np.ndarray) -> "Sparse":
        """Hashes replaced by their places in the sorted ``vocabulary``; others are left out."""
        if not len(vocabulary):
            return Sparse(np.zeros(0, np.int32), self.cut * 0)
        place = np.minimum(np.searchsorted(vocabulary, self.at), len(vocabulary) - 1).astype(np.int32)
        known = vocabulary[place] == self.at
        return Sparse(place[known], np.concatenate(([0], np.cumsum(known)))[self.cut])

    def dot(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(w[self.at])))
        return total[self.cut[1:]] - total[self.cut[:-1]]


_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(column: pa.Array) -> Iterator[Sparse]:
    """Hashes (32 bits) of the distinct words of each text, freed of signs, and of their beginnings."""
    for lo, hi, w in word_chunks(column):
        codes = _bare(w)
        out, cut = [], [0]
        for i in range(hi - lo):
            out.append(np.unique(codes[:, w.first[i]:w.first[i + 1]].astype(np.uint32)))
            cut.append(cut[-1] + len(out[-1]))
        yield Sparse(np.concatenate(out) if out else np.zeros(0, np.uint32), np.array(cut))


def _bare(w: Words) -> np.ndarray:
    """Hashes over letters and digits only, so that a comma or a bracket changes nothing: a row for
    whole words and one for each length of beginning (shorter words: the word again)."""
    if not len(w.start):
        return np.zeros((1 + len(STEMS), 0), np.uint64)
    sizes = w.end - w.start
    heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    at = np.repeat(w.start - heads, sizes) + np.arange(int(sizes.sum()))
    kept = _LETTERS[w.buf[at]]
    letters = np.concatenate(([0], np.cumsum(kept)))
    place = letters[:-1] - np.repeat(letters[heads], sizes)  # among the letters of the word
    value = np.where(kept, _BYTE_CODES[w.buf[at]] * powers(int(sizes.max()) + 1)[place], np.uint64(0))
    whole = np.add.reduceat(value, heads)
    length = np.add.reduceat(kept.astype(np.int64), heads)
    rows = [mix(whole)]
    for n in STEMS:
        stem = np.add.reduceat(np.where(place < n, value, np.uint64(0)), heads)
        rows.append(np.where(length > n, mix(stem + np.uint64(n)), rows[0]))
    return np.array(rows)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(x: Sparse, before: np.ndarray, y: np.ndarray, trusted: np.ndarray, penalty: float = 1.0,
               steps: int = 80) -> Linear:
    """Logistic regression with a squared penalty, by AdaGrad over all rows; both classes count
    alike. Words that occur in the category about as often as by chance get no weight: in a long
    text, many small ones would drown the few that matter. ``trusted`` marks the words (one flag for
    each of the vocabulary) that are never left out. A category that is always or never present gives
    a constant."""
    words = len(trusted)
    n, share = len(y), float(y.mean()) if len(y) else 0.0
    if n == 0 or share in (0.0, 1.0):
        bias = float(np.log((share * n + 0.5) / (n - share * n + 0.5)))
        return Linear(np.zeros(words), np.zeros(before.shape[1]), bias)
    row = np.repeat(np.arange(n), np.diff(x.cut))
    rows = np.bincount(x.at, minlength=words)
    excess = np.bincount(x.at, y[row], minlength=words) - rows * share
    chance = (np.abs(excess) < SIGNIFICANT * np.sqrt(rows * share * (1 - share) + 1)) & ~trusted
    kept = ~chance[x.at]  # the others are not looked at again
    x, row = Sparse(x.at[kept], np.concatenate(([0], np.cumsum(kept)))[x.cut]), row[kept]
    w, v, b = np.zeros(words), np.zeros(before.shape[1]), float(np.log(share / (1 - share)))
    gw, gv, gb = np.full(words, 1e-8), np.full(before.shape[1], 1e-8), 1e-8
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(steps):
        error = (_sigmoid(x.dot(w) + before @ v + b) - y) * weight
        dw = np.bincount(x.at, error[row], minlength=words) / n + penalty * w / n
        dv, db = before.T @ error / n, error.mean()
        gw += dw * dw
        gv += dv * dv
        gb += db * db
        w -= 0.5 * dw / np.sqrt(gw)
        v -= 0.5 * dv / np.sqrt(gv)
        b -= 0.5 * db / np.sqrt(gb)
    return Linear(w, v, float(b))


def predict(model: Linear, x: Sparse, before: np.ndarray) -> np.ndarray:
    return _sigmoid(x.dot(model.weights) + before @ model.earlier + model.bias)


class Chain(NamedTuple):
    categories: tuple[str, ...]
    models: tuple[Linear, ...]
    threshold: float
    vocabulary: np.ndarray  # sorted hashes of the words that carry weight

    def score(self, x: Sparse) -> np.ndarray:
        x = x.within(self.vocabulary)
        before = np.zeros((len(x.cut) - 1, 0))
        for model in self.models:
            before = np.column_stack([before, predict(model, x, before)])
        return before


def fit_chain(x: Sparse, marks: np.ndarray, categories: Sequence[str], fold: np.ndarray,
              trusted: np.ndarray, folds: int = FOLDS) -> Chain:
    """``marks``: rows x categories, 0 or 1. The threshold is where the out-of-fold prediction of the
    last category does best. ``trusted``: hashes of words that are always looked at."""
    vocabulary, rows = np.unique(x.at, return_counts=True)
    vocabulary = vocabulary[(rows >= SEEN_IN) | np.isin(vocabulary, trusted)]
    known = np.isin(vocabulary, trusted)
    x = x.within(vocabulary)
    models, seen = [], np.zeros((len(fold), 0))
    for c in range(len(categories)):
        y = marks[:, c].astype(float)
        out = np.zeros(len(y))
        for f in range(folds):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(outside):
                part = fit_linear(x.rows(inside), seen[inside], y[inside], known)
                out[outside] = predict(part, x.rows(outside), seen[outside])
        models.append(fit_linear(x, seen, y, known))
        seen = np.column_stack([seen, out])
    return Chain(tuple(categories), tuple(models), best_threshold(seen[:, -1], marks[:, -1]), vocabulary)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where the F-measure that counts precision twice is best, halfway in log-odds to the next
    prediction below; DECISION at least. Without a toxic row to learn from, beyond any probability."""
    if not y.any():
        return 2.0
    if y.all():
        return DECISION
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    measure = 1.25 * hits / (np.arange(len(y)) + 1 + 0.25 * y.sum())
    measure[:-1][p[order][:-1] == p[order][1:]] = -1
    k = int(np.argmax(measure))
    low = p[order][k + 1] if k + 1 < len(p) else 0.0
    odds = [np.log(max(q, 1e-9) / max(1 - q, 1e-9)) for q in (p[order][k], low)]
    return max(DECISION, float(_sigmoid(np.array(sum(odds) / 2))))


def train(docs: DataFrame, labels: DataFrame, seeds: dict[str, Sequence[str]] = SEEDS, rows: int = TRAIN_ROWS,
          folds: int = FOLDS) -> Chain:
    """Fits the chain on the texts of ``docs`` that at most ``rows`` of ``labels`` (doc_id, toxic)
    speak of. Rows without an id or label are left out, an id that is called toxic once is toxic; with no
    rows at all nothing is toxic. Only
    hashed words reach the driver."""
    words = {name: np.array(sorted(_hash_words(list_of)), np.uint32) for name, list_of in seeds.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in features(batch.column("text")):
                out += [x.at[x.cut[i]:x.cut[i + 1]].tobytes() for i in range(len(x.cut) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("toxic"), batch.column("spread")],
                                             names=["words", "toxic", "spread"])

    known = labels.select("doc_id", F.col("toxic").cast("long").alias("toxic")).where("toxic is not null")
    spread = F.xxhash64(F.coalesce("text", F.lit("")))
    picked = labelled_sample(docs, known, rows, {"toxic": F.max}).select("text", "toxic", spread.alias("spread"))
    got = picked.mapInArrow(tidy(run), "words binary, toxic long, spread long").orderBy("spread", "toxic").limit(rows).collect()
    at = [np.frombuffer(r.words, np.uint32) for r in got]
    x = Sparse(np.concatenate(at) if at else np.zeros(0, np.uint32), np.concatenate(([0], np.cumsum([len(a) for a in at]))).astype(np.int64))
    toxic = np.array([r.toxic > 0 for r in got], bool)
    fold = np.array([(r.spread >> 8) % folds for r in got], int)
    marks = [toxic & np.array([np.isin(a, hashed).any() for a in at], bool) for hashed in words.values()]
    marks = np.column_stack([*marks, toxic]) if got else np.zeros((0, len(words) + 1))
    del got, at
    chain = fit_chain(x, marks, (*words, LAST), fold, np.concatenate([*words.values(), np.zeros(0, np.uint32)]), folds)
    del x
    give_back()  # the driver goes on to other stages
    return chain


def _hash_words(words: Sequence[str]) -> set[int]:
    out: set[int] = set()
    for lo, hi, w in word_chunks(pa.array(list(words))):
        out |= {int(c) for c in _bare(w)[0].astype(np.uint32)}
    return out


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``toxic_scores`` (probability per category, in chain order) and ``rejected``.

    Reads ``text``; a null or empty text has no words, scores the models' biases and is never
    rejected. Other columns pass through untouched; columns of the two new names are replaced.
    Repeated rows get equal results."""
    docs = docs.drop("toxic_scores", "rejected")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, empty = [], []
            for x in features(batch.column(names.index("text"))):
                p.append(chain.score(x))
                empty.append(np.diff(x.cut) == 0)
            found = np.concatenate(p) if p else np.zeros((0, len(chain.models)))
            none = np.concatenate(empty) if empty else np.zeros(0, bool)
            scores = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores, pa.array((found[:, -1] >= chain.threshold) & ~none)],
                names=[*names, "toxic_scores", "rejected"])

    return docs.mapInArrow(tidy(run), with_columns(docs, toxic_scores=ArrayType(DoubleType()), rejected=BooleanType()))
