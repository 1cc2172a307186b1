import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerpulse.functions import text


def run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]


def five_steps(column):
    out = F.lower(column)
    for name in text.REMOVAL_PATTERNS:
        out = text.remove_class(out, name)
    return out


def by_hand(value):
    value = re.sub(r"(https?://)\S+", " ", value.lower())
    value = re.sub(r"[^a-z0-9]", " ", value)
    words = [w for w in re.findall("[a-z0-9]+", value) if len(w) > 2 and not w.isdigit()]
    return " ".join(words)


def test_clean_document(spark):
    given = ["Buy $TSLA now! https://t.co/x 100 it is GREAT; don't  sell", " english ", None, "", "1 22 333 a b"]
    assert run(spark, given, text.clean_document) == ["buy tsla now great don sell", " english ", None, "", " "]


def test_clean_equals_the_five_steps(spark):
    rnd = random.Random(3)
    parts = ["Buy", "a", "to", "100", "x1", "12b", "https://t.co/A?b=1", "http://x", "#Tag", "don't", "é", "ß", "\n",
             "\t", "  ", "...", "_", "ÀB", "7", "no1", "HTTPS://UP.example", "a-b", "ſ", "K"]
    values = ["".join(rnd.choice(parts) + rnd.choice(["", " ", "  "]) for _ in range(rnd.randint(0, 30)))
              for _ in range(800)]
    assert run(spark, values, text.clean_document) == run(spark, values, five_steps)
    assert [v.strip(" ") for v in run(spark, values, text.clean_document)] == [by_hand(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), min_size=1, max_size=20))
def test_clean_any_text(spark, values):
    assert run(spark, values, text.clean_document) == run(spark, values, five_steps)
    once = run(spark, values, lambda c: F.trim(text.clean_document(c)))
    assert run(spark, once, lambda c: F.trim(text.clean_document(c))) == once


def test_long_runs_do_not_overflow(spark):
    junk = "!" * 200_000 + " 1" * 100_000 + " word" * 50_000 + " " + "7" * 1_000_000
    (out,) = run(spark, [junk], text.clean_document)
    assert out.split() == ["word"] * 50_000


def test_stopwords(spark):
    stop = ["the", "and", "with"]
    given = ["the and", "buy the the dip buy", " the ", "and buy "]
    assert run(spark, given, lambda c: text.drop_stopwords(c, stop)) == ["", "buy dip buy", "", "buy"]
    assert run(spark, ["the and with"], text.clean_document) == ["the and with"]


def test_unknown_class_changes_nothing(spark):
    assert run(spark, ["a 1!"], lambda c: text.remove_class(c, "english")) == ["a 1!"]


def test_other_scalars(spark):
    assert run(spark, ['a,"b",c'], text.sanitize_body) == ["abc"]
    assert run(spark, ["##a #b", ""], text.hashtag_marks) == [3, 0]
    assert run(spark, ["#a, #b_1 # c"], text.hashtags) == [["a", "b_1"]]
    assert run(spark, ["Buy 5 the x1 Été, now"], lambda c: text.alphabetic_words(c, ["the"])) == ["Buy Été now"]
    assert run(spark, [None], lambda c: text.joined_row(F.lit("k"), c, F.lit(2))) == ["k,,2"]


@pytest.mark.parametrize("given, words", [
    ("I don't know", "I do know"), ("it's e-mail, isn't it", "it is it"), ("We cannot go. They're Here.", "We can not go They Here"),
    ("the U.S. market", "market"), ("up. down", "down"), ("Up. Down.", "Up Down"), ("gonna wanna", "gon na wan na"),
    ("$TSLA (up) 5% x1 and/or a_b", "TSLA up"), ("say: yes,no 1,000", "say yes no"), ("can't 'quoted' don't.", "ca do"),
    ("", ""), (None, None), ("Été -- l'eau", "Été"), ("wait… \u201cnow\u201d", "wait now")])
def test_alphabetic_tokens(spark, given, words):
    assert run(spark, [given], lambda c: text.alphabetic_tokens(c, ["the"])) == [words]


def test_load_stopwords(spark, tmp_path, monkeypatch):
    (tmp_path / "w.txt").write_text("the\nand\nthe\n\n")
    assert text.load_stopwords(spark, str(tmp_path / "w.txt")) == ["and", "the"]
    monkeypatch.setattr(text, "MAX_STOPWORDS", 1)
    with pytest.raises(ValueError):
        text.load_stopwords(spark, str(tmp_path / "w.txt"))
    assert "the" in text.default_stopwords()
