import math
import random
import string

import pytest
from pyspark.sql import functions as F

from tickerpulse.functions import lexicon as L
from tickerpulse.functions import sentiment as S
from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.functions.named import register_functions

LEX = Lexicon.of({"good": 1.9, "great": 3.1, "bad": -2.5, "meh": -0.2, "ok": 0.2},
                 {"very": 0.293, "barely": -0.293}, ["not", "never"])
WORDS = ["good", "great", "bad", "meh", "ok", "very", "barely", "not", "never", "but", "stock", "price"]


def brute(words, lex=LEX, caps=None, extra=0.0):
    """The published rules, word by word."""
    caps = caps or [False] * len(words)
    step = 0.733 if 0 < sum(caps) < len(words) else 0.0
    low = [w.lower() for w in words]
    scores = []
    for i, w in enumerate(low):
        if w not in lex.words:
            scores.append(0.0)
            continue
        v = lex.words[w]
        if caps[i]:
            v += step if v > 0 else -step
        for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i - d < 0 or low[i - d] in lex.words:
                continue
            b = lex.boosters.get(low[i - d])
            if b is not None:
                b = -b if v < 0 else b
                if caps[i - d]:
                    b += step if v > 0 else -step
                v += b * damp
            if low[i - d] in lex.negators or "n't" in low[i - d]:
                v *= -0.74
        scores.append(v)
    if "but" in low:
        at = low.index("but")
        scores = [s * (0.5 if i < at else 1.5 if i > at else 1.0) for i, s in enumerate(scores)]
    total = sum(scores)
    total += extra if total > 0 else -extra if total < 0 else 0
    return round(total / math.sqrt(total * total + 15), 4)


def brute_raw(text, lex=LEX):
    words = []
    for token in text.split():
        bare = token.strip(string.punctuation)
        words.append(token if len(bare) <= 2 else bare)
    marks = min(text.count("!"), 4) * 0.292
    asked = text.count("?")
    marks += 0.96 if asked > 3 else asked * 0.18 if asked > 1 else 0
    return brute(words, lex, [w.isupper() for w in words], marks)


def scores(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.x for r in df.select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]


def test_clean_against_brute_force(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    got = scores(spark, texts, lambda c: S.score_clean(c, LEX))
    assert got == pytest.approx([brute(t.split()) for t in texts], abs=1.01e-4)
    assert sum(abs(a - brute(t.split())) > 1e-9 for a, t in zip(got, texts)) <= 2  # ties of the rounding
    assert all(-1 <= x <= 1 for x in got)


def test_raw_against_brute_force(spark):
    rnd = random.Random(2)
    tokens = WORDS + ["GOOD", "BAD", "VERY", "don't", "DON'T", "great!", "(bad)", "ok?", "??", "!!!", "A", ":)", "BUT"]
    texts = ["  ".join(rnd.choice(tokens) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    got = scores(spark, texts, lambda c: S.score_raw(c, LEX))
    assert got == pytest.approx([brute_raw(t) for t in texts], abs=1.01e-4)


def test_table_form_gives_the_same(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    table = spark.createDataFrame(LEX.rows(), "word string, valence double, boost double, negates boolean")
    got = {r.k: r.compound for r in S.score_with_table(df, "k", "t", table).collect()}
    want = scores(spark, texts, lambda c: S.score_clean(c, LEX))
    assert len(got) == len(texts)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_table_form_with_a_list_of_any_size(spark, tmp_path, bits):
    """60 000 words; the posts are scanned once, and words outside the list do not reach the shuffle."""
    rnd = random.Random(9)
    many = [(f"word{i}", 1.0, None, False) for i in range(60_000)]
    table = spark.createDataFrame(LEX.rows() + many, "word string, valence double, boost double, negates boolean")
    texts = [" ".join(rnd.choice(WORDS + ["nothingknown"] * 20) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string").write.parquet(str(tmp_path / "posts"))
    seen = []

    def cut(rows):
        seen.append(rows.cache())
        return seen[0]

    scored = S.score_with_table(spark.read.parquet(str(tmp_path / "posts")), "k", "t", table, bits=bits, cut=cut)
    got = {r.k: r.compound for r in scored.collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(scores(spark, texts, lambda c: S.score_clean(c, LEX)), abs=1e-9)
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and len(seen) == 1
    sent = seen[0].select(F.explode("_words.word").alias("w")).where("w = 'nothingknown'").count()
    assert sent == 0 or bits == 64


def test_table_form_with_repeated_posts_and_a_frequent_word(spark):
    texts = ["very good", "good but bad", "", None, "good " * 300] * 20
    df = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "k int, t string")
    table = spark.createDataFrame(LEX.rows(), "word string, valence double, boost double, negates boolean")
    got = sorted((r.k, r.compound) for r in S.score_with_table(df, "k", "t", table).collect())
    one = scores(spark, texts[:5], lambda c: S.score_clean(c, LEX))
    want = sorted((i % 7, one[i % 5]) for i in range(len(texts)))
    assert [k for k, _ in got] == [k for k, _ in want]
    assert [c for _, c in got] == pytest.approx([c for _, c in want], abs=1e-9)


def test_named_functions_give_the_same(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(WORDS) for _ in range(12)), rnd.choice([None, 0, 3]), 2, 5) for i in range(200)]
    register_functions(spark, LEX)
    df = spark.createDataFrame(rows, "k int, t string, l int, r int, f int")
    want = S.weighted_polarity(S.score_clean(F.col("t"), LEX), F.col("l"), F.col("r"), F.col("f"))
    both = df.select(want.alias("a"), F.expr("computePolarity(t, l, r, f)").alias("b")).collect()
    assert all(r.a == r.b for r in both)
    assert spark.sql("select cleanTextUdf('Buy $TSLA now! https://t.co/x 7') as x").first().x == "buy tsla now "


def test_null_and_empty_score_zero(spark):
    assert scores(spark, [None, "", "stock"], lambda c: S.score_clean(c, LEX)) == [0.0, 0.0, 0.0]
    assert scores(spark, [None, " "], lambda c: S.score_raw(c, LEX)) == [0.0, 0.0]


def test_labels(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0500001,), (-0.0500001,), (0.0,)], "c double")
    assert [r.x for r in df.select(S.label(F.col("c")).alias("x")).collect()] == [
        "neutral", "neutral", "positive", "negative", "neutral"]
    assert [r.x for r in df.select(S.sign_label(F.col("c")).alias("x")).collect()] == [
        "positive", "negative", "positive", "negative", "neutral"]


def test_weights(spark):
    # followers and retweets differ, so using one for the other shows
    df = spark.createDataFrame([(0.5, 2, 3, 1), (0.5, None, 3, None)], "c double, l int, r int, f int")
    got = [r.x for r in df.select(S.weighted_polarity(
        F.col("c"), F.col("l"), F.col("r"), F.col("f")).alias("x")).collect()]
    assert got == [0.5 * 2 * 3 * 4, 0.5 * 4]


def test_score_needs_no_shuffle_and_no_python(spark):
    df = spark.range(10).select(F.lit("very good but bad").alias("t"))
    plan = df.select(S.score_clean(F.col("t"), LEX).alias("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_large_lexicons(spark, monkeypatch):
    big = Lexicon.of({f"w{i}": float(i % 7 - 3) for i in range(8000)})
    got = scores(spark, ["w1 w2 x w7999", "w13"], lambda c: S.score_clean(c, big))
    assert got == pytest.approx([brute(t.split(), big) for t in ["w1 w2 x w7999", "w13"]])
    monkeypatch.setattr(L, "MAX_INLINE_WORDS", 5)
    with pytest.raises(ValueError):
        Lexicon.of({f"w{i}": 1.0 for i in range(6)})
    table = spark.createDataFrame([(f"w{i}", 1.0, None, False) for i in range(6)],
                                  "word string, valence double, boost double, negates boolean")
    with pytest.raises(ValueError):
        Lexicon.from_table(table)
    small = Lexicon.from_table(table.limit(5))
    assert len(small.words) == 5


def test_english_default(spark):
    texts = ["great profit", "not great", "terrible loss", "the price"]
    a, b, c, d = scores(spark, texts, lambda col: S.score_raw(col, L.english()))
    assert a > 0 > b and c < 0 and d == 0


def test_lexicon_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text('good\t1.9\t0.9\t[2, 2]\n:)\t2.0\t1.1\t[2]\n"quoted\t1.0\nbroken\n')
    lex = Lexicon.from_file(spark, str(tmp_path / "words.txt"))
    assert lex.words == {"good": 1.9, ":)": 2.0, '"quoted': 1.0} and "not" in lex.negators
    good, smile = scores(spark, ["very good", "price :)"], lambda c: S.score_raw(c, lex))
    assert good == brute(["very", "good"], lex) and smile > 0


def test_dashboard_dates_by_name(spark):
    register_functions(spark, LEX)
    df = spark.createDataFrame([("2021-10-26T21:22:54Z",), ("garbage",), (None,)], "created string")
    got = spark.sql("select unix_seconds(STR_TO_DATE(created, '%Y-%m-%dT%H:%i:%sZ')) as s from {t}", t=df).collect()
    assert [r.s for r in got] == [1635283374, None, None]
    assert spark.sql("select STR_TO_DATE('03.02.2020', '%d.%m.%Y') = timestamp '2020-02-03' as x").first().x
