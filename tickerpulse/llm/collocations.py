"""Phrases of two to four words whose parts belong together, by stripes.

A stripe belongs to a prefix of one to three words and counts the words that come next. A first pass
over the texts counts words, three more make the stripes of prefixes of one, two and three words. A task adds up the stripes
of a block of text and sends each as one row; the rows of a prefix are merged element by element. One
structure then holds everything: its elements are the phrases and their frequencies, the sum over a
stripe is the frequency of the prefix, and the largest elements of the stripes before and around a
phrase tell whether a longer phrase takes its place.

* A frequent phrase has only frequent parts. Before the stripes of longer prefixes are made, the
  frequent phrases found so far are entered in a set of ``BITS`` bits, which every task gets. What is
  not in it cannot grow into a frequent phrase and counts as the rest of its stripe, so sums remain
  exact. The set never grows; when it fills up, it lets more through, and counts decide as before.
* The stripe of a prefix that is more than a ``HOT``-th part of all text (there are fewer than
  ``HOT`` of them) is dealt to ``spread`` places by the next word and merged by many tasks. Sums and
  maxima over the places combine before they are sent.
* If a phrase lies in a longer one, it lies in one that is a single word longer and at least as
  frequent. So neighbours by one word decide about all longer ones.
* The best phrases of a language are found per language and hashed group first, then among these.

Words are told apart by their text, never by hashes; only the set of bits is hashed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _BASE, _BYTE_CODES, BitSet, bit_set, mix, powers, spans, stage, text_chunks, tidy

MIN_COUNT = 30
LONGEST = 4
SUBSUMED = (80, 100)  # a phrase goes if a longer one around it has this share of its frequency
TOP = 2000
BITS = 1 << 26
BLOCK_BYTES = 1 << 22
BLOCK_ROWS = 1 << 14
GROUPS = 256
HOT = 1000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUTS = np.zeros(256, bool)
_CUTS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_OUTSIDE = _CUTS.copy()
_OUTSIDE[[32, 9]] = True


def _codes(strings: pa.Array) -> np.ndarray:
    """A hash of every string."""
    out = np.zeros(len(strings), np.uint64)
    for lo, hi, raw, cuts in text_chunks(strings, BLOCK_BYTES, BLOCK_ROWS):
        size = np.diff(cuts)
        full = np.flatnonzero(size)
        if len(full):
            place = np.arange(len(raw)) - np.repeat(cuts[:-1], size)
            sums = np.add.reduceat(_BYTE_CODES[raw] * powers(int(size.max()), _BASE)[place], cuts[:-1][full])
            out[lo + full] = sums
        out[lo:hi] = mix(out[lo:hi] + size.astype(np.uint64))
    return out


def _phrase_codes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    total = lang.copy()
    for code, p in zip(words, powers(len(words) + 1, 0xD1342543DE82EF95)[1:]):
        total += code * p
    return mix(total)


def _coded(phrases: DataFrame, size: int) -> DataFrame:
    """The hashes (code) of ``phrases`` (lang, phrase of ``size`` words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs = batch.column("lang").dictionary_encode()
            codes = _codes(langs.dictionary)[langs.indices.to_numpy(zero_copy_only=False)]
            words = pc.list_flatten(batch.column("words")).dictionary_encode()
            each = _codes(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)].reshape(-1, size)
            yield pa.RecordBatch.from_pydict({"code": pa.array(_phrase_codes(codes, list(each.T)).view(np.int64))})

    split = phrases.select("lang", F.split("phrase", " ").alias("words"))
    return split.mapInArrow(tidy(run), "code long")


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): rows sorted by ``columns``, and where each group of equal rows begins."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _block(langs: pa.Array, raw: np.ndarray, cuts: np.ndarray, size: int, known: BitSet, hot: np.ndarray,
           spread: int) -> pa.RecordBatch | None:
    """The stripes of prefixes of ``size`` words in a block of texts; without a size, its words and their counts."""
    buf = _LOWER[raw]
    inside = ~_OUTSIDE[buf]
    start, end, first = spans(inside, cuts)
    n = len(start)
    if not n:
        return None
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(buf[inside].tobytes())).dictionary_encode()
    word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = langs.dictionary_encode()
    lang = np.repeat(names.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(first))
    if not size:
        key = lang * len(words.dictionary) + word
        key, n = np.unique(key, return_counts=True)
        return pa.RecordBatch.from_arrays([
            names.dictionary.take(pa.array(key // len(words.dictionary))).cast(pa.string()),
            words.dictionary.take(pa.array(key % len(words.dictionary))).cast(pa.string()), pa.array(n)], names=["lang", "word", "n"])
    # runs: how many words from here on lie in the same piece
    marks = np.concatenate(([0], np.cumsum(_CUTS[buf])))
    last = np.ones(n, bool)
    last[:-1] = marks[start[1:]] != marks[end[:-1]]
    last[first[1:][first[1:] > 0] - 1] = True
    stops = np.flatnonzero(last)
    left = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n) + 1
    code = _codes(words.dictionary)
    at = np.flatnonzero(left >= size)
    followed = left[at] > size
    padded = np.concatenate((code[word], np.zeros(size, np.uint64)))
    phrase = _phrase_codes(_codes(names.dictionary)[lang], [padded[i:n + i] for i in range(size)])
    seen = known.has(phrase) & (left >= size)
    keep = seen[at]
    at, followed = at[keep], followed[keep]
    followed &= seen[np.minimum(at + 1, n - 1)]
    if not len(at):
        return None
    prefix = lang[at]
    for i in range(size):
        _, prefix = np.unique(prefix * len(words.dictionary) + word[at + i], return_inverse=True)
    after = np.where(followed, word[np.minimum(at + size, n - 1)], -1)
    # elements of stripes, then stripes by prefix and place
    order, heads = _grouped(prefix, after)
    count = np.diff(np.append(heads, len(order)))
    prefix, after, at = prefix[order][heads], after[order][heads], at[order][heads]
    dealt = (after >= 0) & np.isin(phrase[at], hot)
    place = np.where(dealt, (code[after] % np.uint64(spread)).astype(np.int64), 0)
    order, heads = _grouped(prefix, place)
    one = at[order][heads]
    strings = [words.dictionary.take(pa.array(word[one + i])) for i in range(size)]
    joined = strings[0] if size == 1 else pc.binary_join_element_wise(*strings, pa.scalar(" ", pa.large_string()))
    following = after[order]
    ends = pa.array(np.append(heads, len(order)).astype(np.int32))
    following = pc.fill_null(words.dictionary.take(pa.array(following, mask=following < 0)), "").cast(pa.string())
    return pa.RecordBatch.from_arrays([
        names.dictionary.take(pa.array(lang[one])).cast(pa.string()), joined.cast(pa.string()), pa.array(place[order][heads].astype(np.int32)),
        pc.binary_join(pa.ListArray.from_arrays(ends, following), " "),
        pc.binary_join(pa.ListArray.from_arrays(ends, pa.array(count[order]).cast(pa.string())), " ")],
        names=["lang", "prefix", "place", "next", "n"])


def _in_blocks(rows: DataFrame, make: Callable[[pa.Array, np.ndarray, np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, cuts in text_chunks(batch.column("text"), BLOCK_BYTES, BLOCK_ROWS):
                made = make(batch.column("lang").slice(lo, hi - lo), raw, cuts)
                if made is not None:
                    yield made

    return rows.mapInArrow(tidy(run), schema)


def words(rows: DataFrame) -> DataFrame:
    """lang, phrase and a: every word of ``rows`` (lang, text) and how often it occurs."""
    made = _in_blocks(rows, lambda langs, raw, cuts: _block(langs, raw, cuts, 0, None, None, 1), "lang string, word string, n long")
    return made.groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("n").alias("a"))


def stripes(rows: DataFrame, size: int, known: BitSet, hot: np.ndarray, min_count: int = MIN_COUNT,
            spread: int | None = None) -> DataFrame:
    """Merged stripes of ``rows`` (lang, text): lang, prefix, place, total (occurrences of the prefix
    counted here, whatever follows) and next, the elements that occur ``min_count`` times. ``known``
    are the frequent phrases of ``size`` words, ``hot`` the hashes of those that are dealt to places."""
    spark = rows.sparkSession
    spread = spread or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = spark.sparkContext.broadcast(known)
    sent = _in_blocks(rows, lambda langs, raw, cuts: _block(langs, raw, cuts, size, held.value, hot, spread),
                      "lang string, prefix string, place int, next string, n string")
    key = ["lang", "prefix", "place"]
    # words hold no blanks, so a stripe travels as two texts; the rest is the empty word
    split = sent.repartition(*key).select(*key, F.split("next", " ").alias("next"), F.split("n", " ").alias("n"))
    elements = split.select(*key, F.inline(F.arrays_zip("next", "n"))).groupBy(*key, "next").agg(
        F.sum(F.col("n").cast("long")).alias("n"))
    frequent = F.collect_list(F.when((F.col("next") != "") & (F.col("n") >= min_count), F.struct("next", "n")))
    return elements.groupBy(*key).agg(F.sum("n").alias("total"), frequent.alias("next"))


def _extensions(merged: DataFrame) -> DataFrame:
    """(lang, prefix, next, n): the frequent elements."""
    return merged.select("lang", "prefix", F.inline("next"))


def _phrases(merged: DataFrame) -> DataFrame:
    return _extensions(merged).select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("n").alias("a"))


def _around(merged: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, longer): phrases of ``size`` words inside those of one more, with the frequency of these."""
    e = _extensions(merged)
    rest = e.select("lang", F.concat_ws(" ", F.substring_index("prefix", " ", 1 - size) if size > 1 else F.lit(None), "next").alias("phrase"), "n")
    both = e.select("lang", F.col("prefix").alias("phrase"), "n").unionByName(rest)
    return both.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def _scored(candidates: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """``candidates`` (lang, phrase, size, a) with l, r and score of their lowest-scoring cut."""
    cuts = F.array(*[F.struct(
        F.lit(k).alias("k"), F.substring_index("phrase", " ", k).alias("first"),
        F.expr(f"substring_index(phrase, ' ', {k} - size)").alias("rest")) for k in range(1, longest)])
    cut = candidates.select("lang", "phrase", "a", "size", F.inline(cuts)).where("k < size")
    found = counts.toDF("lang", "part", "f")
    parts = cut.select("lang", "phrase", "a", "k", F.inline(F.array(
        F.struct(F.lit(True).alias("is_first"), F.col("first").alias("part")),
        F.struct(F.lit(False).alias("is_first"), F.col("rest").alias("part")))))
    whole = parts.join(found, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_first"), F.col("f"))).alias("r"))
    score = F.expr("(cast(a as decimal(20, 0)) * cast(2000000 as decimal(10, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = whole.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _first(rows: DataFrame, by: list[str | Column], order: list[Column], top: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, subsumed: tuple[int, int] = SUBSUMED,
                 top: int = TOP, bits: int = BITS, spread: int | None = None) -> DataFrame:
    """lang, rank, phrase, a (frequency), l, r (frequencies of its parts), n (words of the language)
    and score of the ``top`` phrases of every language.

    Reads ``lang`` and ``text``. A null language is ``und``; a null or empty text has no words. Texts
    that repeat count as often as they are there. Ties of score and frequency go by the bytes of the
    phrase. A language without frequent phrases does not come out, nor does an empty table.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = stage(words(rows), "words")
    all_words = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    often = (all_words.agg(F.sum("n")).first()[0] or 0) // HOT
    made, frequent = [], counted.where(F.col("a") >= min_count)
    totals = frequent
    for size in range(1, longest):
        known = bit_set(_coded(frequent, size), "code", bits)
        # a word more often than every HOT-th: fewer than HOT of them, and of longer phrases
        hot = _coded(frequent.where(F.col("a") > often), size).toArrow().column("code").to_numpy().view(np.uint64)
        made.append(stage(stripes(rows, size, known, hot, min_count, spread), f"stripes-{size}"))
        frequent = _phrases(made[-1])
    by_size = [_phrases(m).withColumn("size", F.lit(size)) for size, m in enumerate(made, 2)]
    counts, candidates, longer = totals.select("lang", "phrase", "a"), None, None
    for i, found in enumerate(by_size):
        candidates = found if candidates is None else candidates.unionByName(found)
        if i + 1 < len(made):
            counts = counts.unionByName(found.drop("size"))
            more = _around(made[i + 1], i + 2)
            longer = more if longer is None else longer.unionByName(more)
    candidates = stage(candidates, "candidates")
    if longer is not None:
        around = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        candidates = candidates.join(around, ["lang", "phrase"], "left").where(
            F.expr(f"longer is null or cast(longer as decimal(20, 0)) * {subsumed[1]} < cast(a as decimal(20, 0)) * {subsumed[0]}"))
    scored = stage(_scored(candidates.select("lang", "phrase", "a", "size"), counts, longest), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(GROUPS))
    best = _first(_first(scored, ["lang", group], order, top).drop("rank"), ["lang"], order, top)
    return best.join(all_words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
