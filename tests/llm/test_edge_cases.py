"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, per operator."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickerpulse.llm import (context_tree, decontaminate, idfiles, near_dedup, packing, quality_model, repetition,
                             toxicity, url_filter, warc)
from tickerpulse.llm.common import labelled_sample
from tickerpulse.llm import common, components
from tickerpulse.llm.components import connected
from tickerpulse.llm.queries import ship, tokenizer_file

LONG = "word " * 60_000 + "end"
PLAIN = "the quick brown fox jumps over the lazy dog and runs away from here at once"
NEAR = PLAIN + " again"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, value long, word boolean, cls int, length int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", 1, True, 5, 9) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, [(1, PLAIN), (2, NEAR), (2, NEAR), (3, None), (4, ""), (5, " \n\t "), (None, PLAIN), (None, None),
                         (6, LONG), (7, LONG), (8, "two words"), (9, "Two  Words"), (10, "one"), (3, PLAIN)])


@pytest.fixture(scope="module")
def nothing(spark):
    return _docs(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, PLAIN), (1, None), (2, ""), (None, PLAIN), (0, PLAIN)], "item_id long, text string")


def test_near_duplicates(odd, nothing):
    rows = near_dedup.near_duplicates(odd).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    n = len(PLAIN.split()) - 4
    assert got == sorted([
        (1, n, 1, True), (2, n + 1, 1, False), (2, n + 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
        (None, n, 1, False), (None, 0, None, True), (6, 2, 6, True), (7, 2, 6, False), (8, 1, 8, True), (9, 1, 8, False),
        (10, 1, 10, True), (3, n, 1, False)], key=str)
    assert near_dedup.near_duplicates(nothing).count() == 0


def _brute(texts):
    sets = {}
    for d, t in texts.items():
        w = t.split()
        k = min(5, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in texts:
        for b in texts:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[a]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def test_near_duplicates_of_crowds(spark):
    """Chains of edits, truncated copies, a passage that all share, outsiders around an original."""
    import random

    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    base, passage = rng.choices(words, k=90), rng.choices(words, k=60)
    texts = {}
    for i in range(150):  # copies with ever more edits, some near each other and not the original
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(90)] = rng.choice(words)
        texts[len(texts)] = " ".join(copy)
        if i % 10 == 0:
            copy[rng.randrange(90)] = rng.choice(words)
            texts[len(texts)] = " ".join(copy)
    for i in range(30):  # truncated: near each other through the original's words alone
        texts[len(texts)] = " ".join(base[:40 + i])
    for i in range(60):
        texts[len(texts)] = " ".join(passage + rng.choices(words, k=rng.randint(10, 60)))
    step = rng.choices(words, k=60)
    for i in range(25):  # a chain
        step = step[2:] + rng.choices(words, k=2)
        texts[len(texts)] = " ".join(step)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(_docs(spark, list(texts.items()))).collect()}
    assert got == _brute(texts)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 100), (7, 7), (200, 200)], "a long, b long")
    assert {r.node: r.root for r in connected(links).collect()} == {**{i: 1 for i in range(1, 61)}, 90: 90, 100: 90}
    assert connected(links.limit(0)).count() == 0


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "stage", lambda df, name: written.append(name) or common.stage(df, name))
    stars = spark.createDataFrame([(2, 1), (3, 1), (1, 1), (5, 4), (4, 4), (9, 7)], "a long, b long")
    assert {r.node: r.root for r in connected(stars).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 9: 7}
    assert len(written) == 1
    # a chain, and a node below two others
    assert {r.root for r in connected(spark.createDataFrame([(3, 2), (2, 1)], "a long, b long")).collect()} == {1}
    assert {r.root for r in connected(spark.createDataFrame([(3, 2), (3, 1)], "a long, b long")).collect()} == {1}


def test_packing(odd, nothing):
    path = tokenizer_file("byte_bpe_50k.json")
    got = packing.pack(packing.pieces(odd, path, with_ids=True)).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
    assert (got.ids.map(len) == 4 * got.length).all()
    assert sorted(got[got.length == 1].doc_id.fillna(-1)) == [-1, 3, 4]
    long = got[got.doc_id == 6].sort_values("piece")
    assert (long.length.tolist()[1:] == [2048] * (len(long) - 1)) and long.start.tolist()[1] == long.length.tolist()[0]
    assert packing.pack(packing.pieces(nothing, path)).count() == 0


def test_decontamination(spark, odd, nothing, items):
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(odd, items).collect()), key=str)
    assert got == sorted([(d, 0) for d in (1, 2, 2, None, 3) for _ in range(2)], key=str)
    split = decontaminate.leaks(odd, items, items_per_block=1)
    assert sorted(((r.doc_id, r.item_id) for r in split.collect()), key=str) == got
    assert decontaminate.leaks(nothing, items).count() == 0 and decontaminate.leaks(odd, items.limit(0)).count() == 0
    left = decontaminate.clean(odd, items)
    assert left.columns == odd.columns
    assert collections.Counter(r.doc_id for r in left.collect()) == {3: 1, 4: 1, 5: 1, None: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1}


def test_question_and_answer_must_both_occur(spark):
    question, answer = "which of these many words names the colour of the sky", "it is blue on most days of the year"
    items = spark.createDataFrame([(0, question + "\n" + answer)], "item_id long, text string")
    docs = _docs(spark, [(1, f"so {question} well {answer} indeed"), (2, f"so {question} well"), (3, f"indeed {answer}")])
    assert [r.doc_id for r in decontaminate.leaks(docs, items, threshold=0.3).collect()] == [1]


def test_id_files(odd, nothing):
    path = tokenizer_file("word_bpe_49k.json")
    files = idfiles.write(odd, path, file_tokens=100)
    got = idfiles.read(files, with_ids=True).orderBy("start").toPandas()
    assert got.doc_id.fillna(-1).astype(int).tolist() == [-1, -1, 1, 2, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10]
    assert got.start.tolist() == [0, *got.n_tokens.cumsum()[:-1]]
    assert (got.ids.map(len) == 4 * got.n_tokens).all() and files.count() > 1
    assert idfiles.read(idfiles.write(nothing, path)).count() == 0


def test_context_tree(spark, odd, nothing):
    held = F.col("doc_id") == 8
    got = context_tree.score(odd, F.coalesce(held, F.lit(False)), block_bytes=1000).toPandas()
    assert len(got) == 14 and (got.score < 0).all() and got.train_tokens.nunique() == 1
    assert got[got.n_bytes == 0].score.nunique() == 1
    # other blocks, same scores
    again = context_tree.score(odd.repartition(3), F.coalesce(held, F.lit(False))).toPandas()
    assert sorted(got.score.round(6)) == sorted(again.score.round(6))
    assert context_tree.score(nothing, held).count() == 0
    untrained = context_tree.score(_docs(spark, [(1, "ab")]), F.lit(True)).first()
    assert untrained.score == pytest.approx(-24 * 0.30103, rel=1e-5) and untrained.n_known == 0


def test_repetition(odd, nothing):
    got = repetition.judge(odd.withColumn("kept", F.lit("clash"))).toPandas()
    assert len(got) == 14 and not got[got.text.isin([LONG])].kept.any()
    empty = got[got.n_words == 0]
    assert len(empty) == 4 and empty.base_failed.all() and not empty.kept.any()
    assert repetition.judge(nothing).count() == 0


def test_repeated_lines(spark):
    line = "this line is long enough to be counted as a line of its own by all"
    rows = repetition.judge(_docs(spark, [(1, f"{line}\n{line}\n \n \n{line} "), (2, "a\na\r\n")])).orderBy("doc_id").collect()
    assert [r.n_dup_lines for r in rows] == [1, 0] and not rows[0].kept


def test_urls(spark):
    rules = [url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "bad.org", "/x"), url_filter.Rule("allow", "bad.org", "/x")]
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.ORG/p?q#f"), (6, "http://notorg/"), (7, "http://bad.org"),
            (8, "x://u.bad.org/xy://z"), (9, "http://bad.org/" + "y" * 100_000), (9, "http://org/")]
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in urls], "page_id long, url string, host string, _features2 int")
    got = {(r.page_id, r.host, r.path[:5], r.rule, r.verdict) for r in url_filter.judge(pages, rules, None).collect()}
    assert got == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
                   (5, "a.org", "/p", "org/", "allow"), (6, "notorg", "/", None, "allow"), (7, "bad.org", "", None, "allow"),
                   (8, "u.bad.org", "/xy:/", "bad.org/x", "block"), (9, "bad.org", "/yyyy", "org/", "allow"), (9, "org", "/", "org/", "allow")}
    assert url_filter.train(pages.select("url", F.lit(None).cast("int").alias("allowed"))) is None
    one_class = url_filter.train(pages.select("url", F.lit(1).alias("allowed")))
    assert {r.verdict for r in url_filter.judge(pages, [], one_class).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules, one_class).count() == 0


def test_url_model_on_held_out_urls(spark):
    def url(i):
        kind = ("casino", "library")[i % 2]
        return (f"https://www.{kind}{i % 37}.example/{('win', 'read')[i % 2]}/{i}", i % 2)

    labelled = spark.createDataFrame([url(i) for i in range(300)], "url string, allowed int")
    model = url_filter.train(labelled)
    held = spark.createDataFrame([(i, *url(i)) for i in range(1000, 1200)], "page_id long, url string, allowed int")
    right = url_filter.judge(held, [], model).where((F.col("verdict") == "allow") == (F.col("allowed") == 1)).count()
    assert right >= 195
    plan = url_filter.judge(held, [], model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity(spark, odd, nothing, labels):
    chain = toxicity.train(odd, labels)
    got = toxicity.score(odd.withColumn("rejected", F.lit("clash")), chain)
    assert got.count() == 14 and not got.where("rejected and (text is null or trim(text) = '')").count()
    untrained = toxicity.train(nothing, labels.limit(0))
    assert toxicity.score(odd, untrained).where("rejected").count() == 0
    assert toxicity.score(nothing, untrained).count() == 0


def test_quality(odd, nothing, labels):
    model = quality_model.train(odd, labels)
    got = quality_model.score(odd.withColumn("quality_score", F.lit("clash")), model).toPandas()
    assert len(got) == 14 and got.quality_score.between(0, 1).all()
    assert got[got.text.isna() | (got.text == "")].quality_score.nunique() == 1
    untrained = quality_model.train(nothing, labels.limit(0))
    assert quality_model.score(nothing, untrained).count() == 0
    assert set(quality_model.score(odd, untrained).toPandas().quality_score.round(3)) == {0.5}


def test_archives(spark):
    big = "x" * 1000
    rows = [(1, "u1", big), (2, None, big), (3, "u3", None), (4, "u\r\n4", ""), (5, "u5", "x" * 999), (6, "u6", "x" * 999), (None, "n", big),
            (7, "é", "é" * 500), (8, "é", "é" * 500), (8, "again", "é" * 500), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("clash"))
    got = warc.read(warc.write(pages, archive_bytes=2500)).toPandas()
    assert got.error.isna().all() and len(got) == len(rows)
    kinds = collections.Counter((None if i != i else i, k, None if r != r else r) for i, k, r in zip(got.page_id, got.record_type, got.refers_to))
    assert kinds == collections.Counter([
        (1, "revisit", 2), (2, "response", None), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None),
        (None, "revisit", 2), (7, "revisit", 8), (8, "response", None), (8, "response", None), (None, "response", None)])
    assert set(got[got.page_id == 7].payload_bytes) == {1000} and set(got[got.page_id == 2].payload.map(bytes)) == {big.encode()}
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_pipeline_stages(spark, odd, nothing, tmp_path):
    sf = str(tmp_path)
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, "two words")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        now = table
        for name, function in corpus_pipeline.STAGES:
            after = function(spark, now, sf)
            if name != "packing":
                assert after.columns == table.columns
                after.write.parquet(f"{sf}/{name}-{now is table}-{table is docs}-{id(now)}")
                after = spark.read.parquet(f"{sf}/{name}-{now is table}-{table is docs}-{id(now)}")
                assert after.count() <= now.count()
                now = after
            else:
                assert after.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()


def test_pipeline_against_plain_steps(spark):
    """Decisions of the stages, one by one, on the smallest test set."""
    sf = "/root/testdata/sf0.001"
    packed = {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, labels)).where("rejected").collect()}
    left = docs.where(~F.col("doc_id").isin(sorted(toxic)) if toxic else F.lit(True))
    poor = {r.doc_id for r in quality_model.score(left, quality_model.train(left, labels)).where("quality_score < 0.5").collect()}
    kept = {d: t for d, t in rows.items() if d not in toxic | poor}
    first = {d for d, root in _brute_lower(kept).items() if d == root}
    leaked = {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    assert packed == first - leaked


def _brute_lower(texts):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return _brute({d: t.translate(lower) for d, t in texts.items()})


def test_several_labels_of_one_id_follow_a_rule(spark):
    """Whatever the order and the partitions of the labels."""
    rows = [(i % 40, i % 3, int(i % 7 == 0)) for i in range(200)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(3, "again")], "doc_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    want = {i: max(t for d, _, t in rows if d == i) for i in range(40)}
    seen = []
    for labels in (frame.repartition(1), frame.repartition(5), frame.orderBy(F.desc("doc_id"), F.desc("toxic"))):
        got = labelled_sample(docs, labels, 8, {"toxic": F.max}).collect()
        assert all(want[r.doc_id] == r.toxic for r in got)
        seen.append(sorted((r.doc_id, r.text, r.toxic) for r in got))
        assert len({r.doc_id for r in got}) == 8
    assert seen[0] == seen[1] == seen[2]
    trusted = labelled_sample(docs, frame, 100, {"quality": F.min}, F.col("quality") == 1)
    assert {r.doc_id for r in trusted.collect()} == {i for i in range(40) if min(q for d, q, _ in rows if d == i) == 1}


def test_many_items_in_one_pass(spark, odd, items):
    """However many blocks of items there are, the plan reads the documents once."""
    many = items.unionByName(spark.createDataFrame([(i, f"item {i} of many that no text holds at all") for i in range(300)], items.schema))
    found = decontaminate.leaks(odd, many, items_per_block=10)
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    one = decontaminate.leaks(odd, many, items_per_block=1000)
    assert sorted(map(str, found.select("doc_id", "item_id").collect())) == sorted(map(str, one.select("doc_id", "item_id").collect()))
