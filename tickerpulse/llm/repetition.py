"""Quality rules on repetition: how many characters lie in repeated runs of words and repeated lines.

Words and lines are hashed as numpy arrays over a whole piece of text; rolling hashes of runs of five to ten
words find repeated runs. Coverage counts the characters of words inside a run that occurred before
in the text, each once, as a share of all characters of words (published limits for web text: Rae et
al. 2021). Everything happens inside the row; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from .common import _BYTE_CODES, mix, powers, shingle_codes, with_columns, words_of, text_chunks

SYMBOLS = b"#*$%&|<>"
FEWEST_WORDS = 20
WINDOW = 8  # words; windows found twice or more
MOST_REPEATED = (30, 100)
# Largest shares of characters in repeated runs of n words, and in repeated lines.
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose code stands before, and places whose code stands anywhere else."""
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    later = order[1:][same]
    return later, np.union1d(later, order[:-1][same])


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Flags of the ``size`` words that lie in a run of ``n`` words from one of ``starts``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[cuts[1:]] - total[cuts[:-1]]


def _lines(raw: np.ndarray, cuts: np.ndarray, in_word: np.ndarray, chars: np.ndarray):
    """Per line: text it belongs to, hash, whether it has a word, characters of its words."""
    begins = np.concatenate((np.flatnonzero(raw == 10) + 1, cuts[:-1][cuts[1:] > cuts[:-1]]))
    begins = np.unique(begins[begins < len(raw)])
    if not len(begins):
        return (np.zeros(0, np.int64),) * 4
    ends = np.append(begins[1:], len(raw))
    owner = np.searchsorted(cuts, begins, side="right") - 1
    sizes = ends - begins
    place = np.arange(len(raw)) - np.repeat(begins, sizes)
    body = raw != 10
    code = np.add.reduceat(np.where(body, _BYTE_CODES[raw] * powers(int(sizes.max()))[place], np.uint64(0)), begins)
    length = np.add.reduceat(body.astype(np.int64), begins)
    return owner, mix(code + length.astype(np.uint64)), np.add.reduceat(in_word.astype(np.int64), begins) > 0, \
        np.add.reduceat(chars.astype(np.int64), begins)


def measures(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """The counts, the coverage of each run length and of lines, and the verdicts, a row per text."""
    for lo, hi, raw, cuts in text_chunks(column):
        n = hi - lo
        w = words_of(raw, cuts, lower=False)
        in_word = np.zeros(len(raw) + 1, np.int64)
        np.add.at(in_word, w.start, 1)
        np.add.at(in_word, w.end, -1)
        in_word = np.cumsum(in_word[:-1]) > 0
        chars = in_word & ((raw & 0xC0) != 0x80)  # bytes that begin a character
        out = {"n_words": np.diff(w.first), "word_chars": _sums(chars, cuts), "n_symbols": _sums(_SYMBOL[raw], cuts)}
        out |= {k: np.zeros(n, np.int64) for k in ("n_dup_lines", "n_repeat_words")}
        out |= {f"coverage_{k}": np.zeros(n) for k in LIMITS} | {"coverage_lines": np.zeros(n)}
        per_word = _sums(chars, np.append(w.start, len(raw))) if len(w.start) else np.zeros(0, np.int64)
        owner, line, has_word, line_chars = _lines(raw, cuts, in_word, chars)
        if len(owner):
            keep = np.flatnonzero(has_word)
            later, _ = repeated(mix(line[keep] + owner[keep].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            out["n_dup_lines"] = np.bincount(owner[keep][later], minlength=n)
            out["coverage_lines"] = np.bincount(owner[keep][later], line_chars[keep][later], minlength=n) / np.maximum(out["word_chars"], 1)
        for i in range(n):
            a, b = w.first[i], w.first[i + 1]
            code, size, own = w.code[a:b], b - a, per_word[a:b]
            for k in LIMITS:
                if size <= k:
                    break
                later, anywhere = repeated(shingle_codes(code, k))
                if not len(later):
                    break  # no run of k words recurs, so no longer one does
                out[f"coverage_{k}"][i] = own[covered(later, k, size)].sum() / own.sum()
                if k == WINDOW:
                    out["n_repeat_words"][i] = covered(anywhere, k, size).sum()
        out["base_failed"] = (out["n_words"] < FEWEST_WORDS) | (
            MOST_REPEATED[1] * out["n_repeat_words"] > MOST_REPEATED[0] * out["n_words"])
        over = out["coverage_lines"] > LINE_LIMIT
        for k, limit in LIMITS.items():
            over |= out[f"coverage_{k}"] > limit
        out["kept"] = ~out["base_failed"] & ~over
        yield out


FIELDS = [*[StructField(k, LongType()) for k in COUNTS],
          *[StructField(f"coverage_{k}", DoubleType()) for k in (*LIMITS, "lines")],
          StructField("base_failed", BooleanType()), StructField("kept", BooleanType())]


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts, coverages, base_failed and kept; columns of these names are replaced.

    Reads ``text``. A null, empty or blank text has no words, counts 0 throughout and fails for too
    few words. Repeated rows get equal results."""
    docs = docs.drop(*[f.name for f in FIELDS])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(measures(batch.column(names.index("text"))))
            found = [pa.array(np.concatenate([p[f.name] for p in parts]) if parts else [], _ARROW[type(f.dataType)]) for f in FIELDS]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*names, *[f.name for f in FIELDS]])

    return docs.mapInArrow(run, with_columns(docs, **{f.name: f.dataType for f in FIELDS}))


_ARROW = {LongType: pa.int64(), DoubleType: pa.float64(), BooleanType: pa.bool_()}
