import pytest

from tickerpulse.llm import decontaminate
from tickerpulse.llm.queries import ship

QUESTION = "which of these many words names the colour that a clear sky has at noon in early summer"
SHORT_QUESTION = "which colour has the clear summer sky at noon"
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def _found(spark, texts, items, **options):
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = decontaminate.leaks(docs, spark.createDataFrame(list(enumerate(items)), ITEMS), **options).collect()
    return sorted((r.doc_id, r.item_id) for r in got)


@pytest.mark.parametrize("answer, altered", [
    ("deep azure above everyone", "deep azure above everyone.%%%"),
    ("deep azure above everyone", "deep azure above everyonejunk and more"),
    ("deep azure above everyone", "deep altered above everyone"),
    ("deep azure above", "deep azure junk"),
    ("deep azure", "deep junk"),
    ("azure", "azurejunk"),
    ("deep azure above everyone looking upwards today", "deep azure above altered looking upwards today"),
    ("deep azure above everyone looking upwards today", "deep azure above and everyone looking upwards today"),
])
@pytest.mark.parametrize("question", [QUESTION, SHORT_QUESTION])
def test_one_altered_word_loses_no_item(spark, question, answer, altered):
    assert _found(spark, [f"so {question}\n{altered}"], [f"{question}\n{answer}"]) == [(0, 0)]


def test_altered_word_of_a_short_question(spark):
    assert _found(spark, ["so which colour has the dear summer sky at noon\ndeep azure above everyone indeed"],
                  [f"{SHORT_QUESTION}\ndeep azure above everyone"]) == [(0, 0)]


def test_one_part_alone_is_no_item(spark):
    items = [f"{QUESTION}\n{a}" for a in ("azure", "deep azure", "deep azure above", "deep azure above everyone")]
    texts = [f"so {QUESTION} nobody can tell from here", "deep azure above everyone", f"deep azure above everyone and so on {QUESTION[:30]}"]
    assert _found(spark, texts, items, threshold=0.3) == []


def test_case_of_all_scripts_and_signs(spark):
    item = "Él dijo ñandú, élan ópera último: ¿qué índice?\nÁrbol Ñu"
    assert _found(spark, [f"x {item.upper()}!! y", "«" + item.replace(" ", "%%% ") + "»"], [item]) == [(0, 0), (1, 0)]
    assert _found(spark, ["a +++ --- === >>> z"], ["+++ --- === >>>"]) == [(0, 0)]
