"""Lexicon sentiment (after Hutto & Gilbert, ICWSM 2014) as row-local column expressions.

A post is scored inside its own row: no explode, no join, no shuffle, no Python. The same
expression therefore serves batch and streaming plans, and a frequent author, term or copied
text costs no more than any other row. Emoji and multi-word idioms are not covered.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .lexicon import Lexicon
from .text import let

# Fixed values of the published method.
DAMPING = (1.0, 0.95, 0.9)      # effect of a modifier 1, 2, 3 words back
NEGATION = -0.74
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
CAPS_STEP = 0.733
EXCLAIM_STEP, EXCLAIM_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MANY = 0.18, 0.96
ALPHA = 15.0
LABEL_CUT = 0.05
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""


def _compound(total: Column) -> Column:
    # adding 0.0 turns a negative zero into zero
    return F.round(total / F.sqrt(total * total + F.lit(ALPHA)), 4) + F.lit(0.0)


def _modified(valence: Column, previous: list[Column], caps_step: Column | None) -> Column:
    """Apply the words 1, 2 and 3 places back, nearest first. Lexicon words modify nothing."""
    steps = F.array(*[
        F.struct(p.alias("w"), F.lit(d).alias("damping")) for p, d in zip(previous, DAMPING)
    ])

    def step(acc: Column, s: Column) -> Column:
        boost = F.coalesce(s["w"]["b"], F.lit(0.0)) * F.when(acc < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        if caps_step is not None:
            shout = F.when(acc > 0, caps_step).otherwise(-caps_step)
            boost += F.when(s["w"]["c"] & s["w"]["b"].isNotNull(), shout).otherwise(F.lit(0.0))
        flip = F.when(s["w"]["n"], F.lit(NEGATION)).otherwise(F.lit(1.0))
        changed = (acc + boost * s["damping"]) * flip
        return F.when(s["w"]["v"].isNotNull(), acc).otherwise(changed)

    return F.aggregate(steps, valence, step)


def _but_factor(index: Column, but_at: Column) -> Column:
    """``but_at`` is the 1-based place of the first "but", 0 if there is none."""
    place = index + F.lit(1)
    return (
        F.when((but_at == 0) | (place == but_at), F.lit(1.0))
        .when(place < but_at, F.lit(BEFORE_BUT))
        .otherwise(F.lit(AFTER_BUT))
    )


def _word_total(hits: Column, previous: Callable[[Column], Column], but_at: Column,
                caps: Column | None = None, caps_step: Column | None = None) -> Column:
    """Sum of the word scores. ``hits`` holds struct(v, b, n) or null per word, ``previous`` gives
    the same with ``c`` for the word at a place, ``caps`` tells which words are in capitals."""

    def score(hit: Column, i: Column) -> Column:
        valence = hit["v"]
        if caps is not None:
            shout = F.when(valence > 0, caps_step).otherwise(-caps_step)
            valence = F.when(F.get(caps, i), valence + shout).otherwise(valence)
        before = [previous(i - F.lit(d)) for d in (1, 2, 3)]
        scored = _modified(valence, before, caps_step) * _but_factor(i, but_at)
        return F.when(hit["v"].isNull(), F.lit(0.0)).otherwise(scored)

    return F.aggregate(F.transform(hits, score), F.lit(0.0), lambda a, b: a + b)


def score_words(words: Column, lexicon: Lexicon) -> Column:
    """Compound score in [-1, 1] of an array of lower-case words; null counts as empty."""
    find = lexicon.finder()

    def of_words(given: Column) -> Column:
        bound = F.struct(
            F.transform(given, find).alias("hits"), F.array_position(given, "but").alias("but_at"))
        return let(bound, lambda s: _word_total(s["hits"], lambda i: F.get(s["hits"], i), s["but_at"]))

    given = F.coalesce(words, F.array().cast("array<string>"))
    return let(let(given, of_words), _compound)


def score_clean(clean: Column, lexicon: Lexicon) -> Column:
    """``score_words`` of cleaned text (lower-case words split by blanks)."""
    return score_words(F.filter(F.split(clean, " "), lambda w: w != ""), lexicon)


def _stripped(tokens: Column) -> Column:
    """Tokens without punctuation at their ends; what would be left with two letters or fewer
    (an emoticon, say) stays as it is."""
    bare = F.transform(tokens, lambda t: F.btrim(t, F.lit(PUNCTUATION)))
    return F.zip_with(tokens, bare, lambda t, b: F.when(F.length(b) <= 2, t).otherwise(b))


def _emphasis(text: Column) -> Column:
    """What exclamation and question marks add."""
    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    questions = count("?")
    asked = (
        F.when(questions > 3, F.lit(QUESTION_MANY))
        .when(questions > 1, questions * F.lit(QUESTION_STEP))
        .otherwise(F.lit(0.0))
    )
    return F.least(count("!"), F.lit(EXCLAIM_MAX)) * F.lit(EXCLAIM_STEP) + asked


def score_raw(text: Column, lexicon: Lexicon) -> Column:
    """Compound score of text as written: capitals, contractions and ``!?`` count too."""
    find = lexicon.finder()
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return let(F.struct(words.alias("words"), F.transform(words, F.lower).alias("low")), looked_up)

    def looked_up(s: Column) -> Column:
        caps = F.zip_with(s["words"], s["low"], lambda w, low: (w != low) & (w == F.upper(w)))
        hits = F.transform(s["low"], find)
        return let(F.struct(s["low"].alias("low"), hits.alias("hits"), caps.alias("caps")), summed)

    def summed(s: Column) -> Column:
        shouted = F.size(F.filter(s["caps"], lambda c: c))
        # capitals only stand out among other words
        step = F.when((shouted > 0) & (shouted < F.size(s["caps"])), F.lit(CAPS_STEP)).otherwise(F.lit(0.0))

        def previous(i: Column) -> Column:
            hit = F.get(s["hits"], i)
            negates = F.coalesce(hit["n"], F.lit(False)) | F.get(s["low"], i).contains("n't")
            return F.struct(hit["v"].alias("v"), hit["b"].alias("b"), negates.alias("n"),
                            F.get(s["caps"], i).alias("c"))

        bound = F.struct(F.array_position(s["low"], "but").alias("but_at"), step.alias("caps_step"))
        return let(bound, lambda t: _word_total(s["hits"], previous, t["but_at"], s["caps"], t["caps_step"]))

    tokens = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    added = _emphasis(text)

    def emphasised(s: Column) -> Column:
        total, mark = s["total"], s["mark"]
        return (F.when(total > 0, total + mark).when(total < 0, total - mark).otherwise(total))

    total = let(F.struct(let(let(tokens, _stripped), of_words).alias("total"), added.alias("mark")), emphasised)
    return let(total, _compound)


def weighted_polarity(compound: Column, likes: Column, retweets: Column, followers: Column) -> Column:
    """Compound times (followers+1)(likes+1)(retweets+1); a missing count counts as 0."""
    def factor(c: Column) -> Column:
        return F.coalesce(c.cast("double"), F.lit(0.0)) + F.lit(1.0)

    return compound * factor(followers) * factor(likes) * factor(retweets)


def label(compound: Column) -> Column:
    """positive above 0.05, negative below -0.05, else neutral."""
    return (
        F.when(compound > LABEL_CUT, "positive")
        .when(compound < -LABEL_CUT, "negative")
        .otherwise("neutral")
    )


def sign_label(polarity: Column) -> Column:
    """Label by the sign of a weighted polarity; null stays null."""
    return (
        F.when(polarity > 0, "positive").when(polarity < 0, "negative").when(polarity == 0, "neutral")
    )


def _may_tell(telling: DataFrame, bits: int) -> Callable[[Column], Column]:
    """A test that words of ``telling`` always pass and others hardly ever: a set of ``bits`` bits by a
    hash of the word, a constant of the query. A list too long for it lets more words through."""
    at = F.pmod(F.xxhash64("word"), F.lit(bits))
    rows = telling.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).collect()  # bits / 64 at most
    masks = [0] * (bits // 64)
    for slot, mask in rows:
        masks[slot] = mask
    table = F.from_json(F.lit(json.dumps(masks)), "array<bigint>")

    def test(word: Column) -> Column:
        at = F.pmod(F.xxhash64(word), F.lit(bits))
        mask = F.get(table, F.shiftright(at, 6).cast("int"))
        return F.call_function("shiftrightunsigned", mask, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def score_with_table(df: DataFrame, key: str, clean: str, lexicon: DataFrame, salts: int = 8, bits: int = 1 << 20,
                     cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``score_clean`` for a lexicon of any size: (key, compound) for every row of ``df``.

    ``lexicon`` is (word, valence, boost, negates), one row per word. Posts may repeat: scores are
    worked out per text, and every row of ``df`` gets that of its own. The posts are read once; what
    is written (``cut``) and shuffled of them is a digest and the words that a set of ``bits`` bits takes for
    words of the lexicon or "but". Each word is dealt to ``salts`` places, so that a frequent one does not
    end up in a single task. The sort per text is bounded by its length.
    """
    text = F.coalesce(F.col(clean), F.lit(""))
    known = _with_but(lexicon)
    may_tell = _may_tell(known, bits)
    numbered = F.transform(F.filter(F.split(text, " "), lambda w: w != ""),
                           lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    texts = cut(df.select(key, F.sha2(text, 256).alias("_digest"),
                          F.filter(numbered, lambda s: may_tell(s["word"])).alias("_words")))
    words = texts.select("_digest", F.inline("_words"))
    telling = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = words.withColumn("_salt", F.pmod(F.xxhash64("_digest", "pos"), F.lit(salts)).cast("int"))
    marked = salted.join(telling, ["word", "_salt"]).dropDuplicates(["_digest", "pos"])
    in_post = W.partitionBy("_digest").orderBy("pos")
    valence, boost = F.col("valence").cast("double"), F.col("boost").cast("double")
    code = F.struct(
        "pos", valence.alias("v"), boost.alias("b"),
        F.coalesce("negates", F.lit(False)).alias("n"))

    def back(distance: int) -> Column:
        # the marked word exactly ``distance`` places back, if any
        near = [F.lag(code, hop).over(in_post) for hop in range(1, distance + 1)]
        hits = [F.when(c["pos"] == F.col("pos") - distance, c) for c in near]
        return F.coalesce(*hits)

    placed = marked.select(
        "_digest", "pos", valence.alias("valence"),
        *[back(d).alias(f"back{d}") for d in (1, 2, 3)],
        F.min(F.when(F.col("word") == "but", F.col("pos") + 1)).over(W.partitionBy("_digest")).alias("but_at"),
    ).where(F.col("valence").isNotNull())
    value = _modified(F.col("valence"), [F.col(f"back{d}") for d in (1, 2, 3)], None)
    scored = placed.select(
        "_digest", (value * _but_factor(F.col("pos"), F.coalesce("but_at", F.lit(0)))).alias("value"))
    totals = scored.groupBy("_digest").agg(F.sum("value").alias("total"))
    return texts.select(key, "_digest").join(totals, "_digest", "left").select(
        key, _compound(F.coalesce("total", F.lit(0.0))).alias("compound"))


def _with_but(lexicon: DataFrame) -> DataFrame:
    """Words that carry meaning, "but" among them."""
    rows = lexicon.select("word", "valence", "boost", "negates")
    but = lexicon.sparkSession.range(1).select(F.lit("but").alias("word")).join(rows, "word", "left")
    telling = rows.where((F.col("word") != "but") & (
        F.col("valence").isNotNull() | F.col("boost").isNotNull() | F.col("negates")))
    return telling.unionByName(but.select(rows.columns))
