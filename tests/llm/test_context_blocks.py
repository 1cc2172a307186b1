"""op6: what passes between Spark and Python stays small, however large a block is."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import context_tree
from tickerpulse.llm.common import CHUNK_BYTES
from tickerpulse.llm.queries import ship

HELD = "doc_id % 5 = 0"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefgh éß\n", k=rng.randint(0, 9000))) for _ in range(300)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()


def test_rows_of_a_block_are_small(docs):
    """Before, a block was one row with all its texts and all its runs."""
    made = context_tree.blocks(docs, F.expr(HELD), 4).cache()
    sizes = made.select(F.expr("aggregate(texts, 0, (n, t) -> n + length(t))").alias("texts"), F.length("keys").alias("keys")).toPandas()
    assert made.select("block").distinct().count() == 2 and sizes.texts.sum() > 4 * CHUNK_BYTES
    assert sizes.texts.max() <= CHUNK_BYTES + 20_000 and 0 < sizes["keys"].max() <= 8 * context_tree.SLICE < sizes["keys"].sum()
    assert made.select(F.explode("doc_id")).count() == 300


def test_counts_of_a_block(docs):
    code = context_tree._keys(context_tree.blocks(docs, F.expr(HELD), 4), True).groupBy("block").agg(F.sum("n").alias("n"), F.count("*").alias("d"))
    words, distinct = collections.Counter(), collections.defaultdict(set)
    for r in docs.withColumn("part", F.spark_partition_id()).withColumn("held", F.expr(HELD)).collect():
        own = r.text.split()
        words[r.part] += 0 if r.held else len(own)
        distinct[r.part] |= set(own)
    assert {r.block >> 32: (r.n, r.d) for r in code.collect()} == {p: (words[p], len(distinct[p])) for p in words}


def test_counts_are_merged_as_they_come():
    """Parts with the same codes are merged as they come, not at the end of the block."""
    rng, store, want = np.random.default_rng(1), context_tree._Counts(), collections.Counter()
    for _ in range(60):
        codes = rng.integers(0, 50_000, 60_000)
        trains = rng.random(len(codes)) < 0.9
        store.add(codes, trains)
        want.update(codes[trains].tolist())
        assert sum(len(part) for part, _ in store.parts) <= context_tree.MERGED_AT
    code, count = store.merge()
    assert code.tolist() == sorted(set(code.tolist())) and {int(c): int(n) for c, n in zip(code, count) if n} == want


def test_rows_are_packed_by_block(spark):
    rows = [(b, k, float(k * k)) for k in range(400) for b in (3, 1, 2)]
    frame = spark.createDataFrame(rows, "block long, key long, value double").coalesce(1)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    for at_once, n in ((1 << 19, 3), (300, 12)):
        spark.conf.set(batch, 100)
        got = context_tree.packed(frame, True, at_once).collect()
        spark.conf.set(batch, before)
        assert len(got) == n
        found = collections.defaultdict(dict)
        for r in got:
            found[r.block].update(zip(context_tree._from_planes([r["keys"]], np.int64).tolist(),
                                      context_tree._from_planes([r["values"]], np.float64).tolist()))
        assert found == {b: {k: float(k * k) for k in range(400)} for b in (1, 2, 3)} and all(r.word for r in got)


def test_scores_do_not_depend_on_blocks(docs):
    one, many = ({r.doc_id: r for r in context_tree.score(docs, F.expr(HELD), block_bytes=n).collect()} for n in (10 << 20, 3000))
    assert len(one) == len(many) == 300
    for d, r in one.items():
        assert r[:5] == many[d][:5] and r[5:] == pytest.approx(many[d][5:], rel=1e-9)
