"""Text quality by positive-unlabelled learning.

Trusted good texts and unlabelled web text are all that the fit sees. With the share of good texts in
the web (the class prior) known, the risk of calling unlabelled text bad can be freed of the good
texts hidden in it: risk = prior * loss(good as good) + max(0, loss(all as bad) - prior * loss(good as
bad)). The second part estimates the risk on bad texts, which cannot be negative; holding it at zero
keeps a flexible model from fitting the trusted texts only (Kiryo et al. 2017).

Features of a text are the shapes of its characters: classes of letters, digits, blanks and signs,
counted in runs of one to four classes, and how often words and signs repeat. Nothing depends on the
language, the source or the id.

Only the fit is bounded (``POSITIVES`` and ``UNLABELLED`` texts picked by a hash); every whole text is
scored inside its row, with no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import give_back, labelled_sample, text_chunks, tidy, with_columns, words_of

POSITIVES = 4_000
UNLABELLED = 8_000
SHAPES = 1 << 10
EXTRA = 8
STEPS = 300
COLUMNS = 64  # whose spread is taken at once
RANKINGS = (0.5, 0.7)
BIN_RISK, BIN_WEIGHT = 0.1, 0.01  # of the bound by which the prior is read off
HIDDEN = 16

# Character classes: 0 blank, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII, 5 line end,
# 6 end of sentence, 7 other punctuation; every other sign is a class of its own.
_CLASS = np.arange(256, dtype=np.int64)
_CLASS[[32, 9, 11, 12, 13]] = 0
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 4
_CLASS[10] = 5
_CLASS[[33, 46, 63]] = 6
_CLASS[[34, 39, 40, 41, 44, 45, 58, 59]] = 7


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows x (SHAPES + EXTRA): square roots of the shares of shapes, and eight measures of a text."""
    for lo, hi, raw, cuts in text_chunks(column):
        kind = _CLASS[raw]
        # a run of one letter class counts as one place, so that word length matters little
        change = np.ones(len(kind), bool)
        change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] > 4)
        inner = cuts[:-1][cuts[:-1] < len(kind)]
        change[inner] = True
        at = np.flatnonzero(change)
        run = kind[at]
        w = words_of(raw, cuts)
        marks = np.searchsorted(at, cuts)
        out = np.zeros((hi - lo, SHAPES + EXTRA), np.float32)
        for i in range(hi - lo):
            own = run[marks[i]:marks[i + 1]]
            if not len(own):
                continue
            key, shapes = np.zeros(len(own), np.int64), []
            for n in range(1, 5):
                key = key[:len(own) - n + 1] * 256 + own[n - 1:] if n > 1 else own + 1
                if len(key):
                    shapes.append((key * 2654435761 + n * 40503) % 2**32 >> 16)
            found = np.bincount(np.concatenate(shapes) % SHAPES, minlength=SHAPES)
            out[i, :SHAPES] = np.sqrt(found / found.sum())
            out[i, SHAPES:] = _measures(kind[cuts[i]:cuts[i + 1]], w.code[w.first[i]:w.first[i + 1]],
                                        (w.end - w.start)[w.first[i]:w.first[i + 1]])
        yield out


def _measures(kind: np.ndarray, code: np.ndarray, sizes: np.ndarray) -> list[float]:
    n, words = len(kind), len(code)
    if not words:
        return [0.0] * EXTRA
    different = len(np.unique(code))
    twice = np.unique(code[:-1] + np.uint64(3) * code[1:]) if words > 1 else code
    return [float((kind == 2).sum() / n), float((kind == 3).sum() / n), float((kind > 7).sum() / n),
            float((kind == 4).sum() / n), different / words, len(twice) / max(1, words - 1),
            float(min(sizes.mean(), 40.0) / 10), float(np.log1p(words) / 10)]


class Model(NamedTuple):
    """A network with one hidden layer over centred features."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    bias: float
    slope: float
    shift: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) * self.scale @ self.inner + self.inner_bias) @ self.outer + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -35, 35)))


def fit(good: np.ndarray, web: np.ndarray, prior: float, steps: int = STEPS, seed: int = 11) -> Model:
    """Minimises the non-negative risk with the sigmoid loss by Adam over mixed batches."""
    prior = min(max(prior, 0.01), 0.99)
    seen = np.concatenate([good, web]) if len(good) + len(web) else np.zeros((1, SHAPES + EXTRA), np.float32)
    mean, scale = seen.mean(0), np.zeros(seen.shape[1], np.float32)
    spread = np.concatenate([seen[:, i:i + COLUMNS].std(0) for i in range(0, seen.shape[1], COLUMNS)])  # copies what it is given
    del seen
    scale[spread > 0] = 1 / np.maximum(spread[spread > 0], 0.02)
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, 0.05, (len(mean), HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
         rng.normal(0, 0.3, HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
    if not len(good) or not len(web):
        return Model(mean, scale, p[0] * 0, p[1], p[2] * 0, 0.0, 0.0, float(np.log(prior / (1 - prior))))
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, steps + 1):
        xa, xb = good[rng.integers(0, len(good), 256)], web[rng.integers(0, len(web), 512)]
        x = (np.concatenate([xa, xb]) - mean) * scale
        h = np.tanh(x @ p[0] + p[1])
        z = h @ p[2] + p[3][0]
        s = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        za, zb = s[:len(xa)], s[len(xa):]
        slope = s * (1 - s)
        # loss of calling x good is 1 - s, of calling it bad s
        bad = zb.mean() - prior * za.mean()
        d = np.empty(len(x), np.float32)
        if bad >= 0:
            d[:len(xa)] = (-prior - prior) / len(xa)
            d[len(xa):] = 1 / len(xb)
        else:  # the estimate went below zero: step back up
            d[:len(xa)] = prior / len(xa)
            d[len(xa):] = -1 / len(xb)
        d *= slope
        dh = np.outer(d, p[2]) * (1 - h * h)
        g = [x.T @ dh + 1e-3 * p[0], dh.sum(0), h.T @ d + 1e-3 * p[2], np.array([d.sum()], np.float32)]
        for i in range(4):
            first[i] = 0.9 * first[i] + 0.1 * g[i]
            second[i] = 0.999 * second[i] + 0.001 * g[i] ** 2
            p[i] = p[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0, 0.0)


def estimate_prior(good: np.ndarray, web: np.ndarray) -> float:
    """Share of good texts among ``web``, from trusted ``good`` ones alone. A model fitted on half of
    both ranks the other halves, and the other way round; the mean of both counts. Above a place in that ranking where hardly any bad text is left, web
    texts are as frequent as good ones times that share; the place is the one with the lowest upper
    confidence bound (Garg et al. 2021, best bin estimation). Bad texts left above it only raise the
    figure, so places are sought in several rankings, by models that take different shares for true.
    Without texts to rank it is a half."""
    if min(len(good), len(web)) < 4:
        return 0.5
    found = []
    for one, other in ((0, 1), (1, 0)):
        lowest, share = math.inf, 1.0
        for assumed in RANKINGS:
            model = fit(good[one::2], web[one::2], assumed)
            p, u = np.sort(model.raw(good[other::2])), np.sort(model.raw(web[other::2]))
            cuts = np.unique(p)
            above_p = 1 - np.searchsorted(p, cuts) / len(p)
            above_u = 1 - np.searchsorted(u, cuts) / len(u)
            slack = sum(math.sqrt(math.log(4 / BIN_RISK) / (2 * n)) for n in (len(p), len(u)))
            bound = (above_u + (1 + BIN_WEIGHT) * slack) / above_p
            best = int(np.argmin(bound))
            if bound[best] < lowest:
                lowest, share = float(bound[best]), float(above_u[best] / above_p[best])
        found.append(min(share, 1.0))
    return sum(found) / 2


def _taken(texts: DataFrame, rows: int) -> np.ndarray:
    """Features of at most ``rows`` of the ``texts``, picked by a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [r.astype(np.float16).tobytes() for part in features(batch.column("text")) for r in part]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("spread")], names=["x", "spread"])

    hashed = texts.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("spread"))
    got = hashed.mapInArrow(tidy(run), "x binary, spread long").orderBy("spread", "x").limit(rows).collect()
    out = np.empty((len(got), SHAPES + EXTRA), np.float32)
    for i, r in enumerate(got):
        out[i] = np.frombuffer(r.x, np.float16)
    return out


def train(docs: DataFrame, labels: DataFrame, most_positives: int = POSITIVES,
          most_unlabelled: int = UNLABELLED) -> Model:
    """Trusted positives: texts of ``docs`` that ``labels`` (doc_id, quality) calls good. Unlabelled:
    texts of ``docs`` picked by a hash of their id, whatever their label. Prior: estimated from these
    two; nothing is learnt from texts called bad. Rows without an id or quality are left out, an id
    that is called bad once is not trusted; without any positive or any document the model is the
    prior alone."""
    known = labels.select("doc_id", "quality").where("quality is not null")
    positives = labelled_sample(docs, known, most_positives, {"quality": F.min}, F.col("quality") == 1)
    web = labelled_sample(docs, docs.select("doc_id"), most_unlabelled)
    good, seen = _taken(positives, most_positives), _taken(web, most_unlabelled)
    model = fit(good, seen, estimate_prior(good, seen))
    del good, seen
    give_back()  # the driver goes on to other stages
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``quality_score`` in [0, 1]; an existing column of that name is replaced.

    Reads ``text``; a null, empty or blank text has no shapes, which is a point of its own in the
    feature space, and is scored there. Repeated rows get equal scores."""
    docs = docs.drop("quality_score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(x) for x in features(batch.column(names.index("text")))]
            scores = np.concatenate(found).astype(float) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, "quality_score"])

    return docs.mapInArrow(tidy(run), with_columns(docs, quality_score=DoubleType()))
