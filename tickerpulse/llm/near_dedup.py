"""Near-duplicate documents by bottom-k sketches.

A document is the set of its distinct five-word shingles (64-bit hashes). One hash function orders
them; the k smallest are its sketch, which samples the set and, merged with another, samples the
union of both. The steps:

1. Documents with equal sets form a class; from here on only classes are compared, so copies in
   any number cost one row each.
2. Inverted lists: for every retained value the classes that retain it. Two classes at the
   threshold share at least m of their k values (m lies ``SPREAD`` standard deviations below the
   expectation), so they share one of the k - m + 1 rarest values of either: only those are listed,
   and values that a large part of the corpus retains drop out of all lists but those of documents
   made of little else.
3. Every list compares its members with one of them, the pivot: the one whose values are retained by
   the most classes on average, hence the likeliest original. Full sets give the exact distances; near ones connect.
4. What is left are outsiders, members not connected with their pivot. They meet the other members
   of their lists, except those that the pivot rules out: Jaccard distance is a metric, so distances
   to the pivot may differ by no more than linked classes do; and two classes have in common at most
   what the one of them that has less of the pivot's shingles has of these, plus what they share
   beyond the pivot. The union sketch of each pair left estimates the similarity, and full sets
   decide on what passes. For a few rounds only the outsider nearest to the pivot does this, as
   the next pivot: what it connects need not be compared any more. Then all that are left do.

So any two classes of one list are compared, ruled out, or connected by links that hold. No list is cut, and no pair of documents within a group of copies is written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shingle_codes, stage, tidy, word_chunks
from .components import connected

SHINGLE = 5
SIMILARITY = (75, 100)  # links: 100 * intersection >= 75 * union
SKETCH = 64
ROUNDS = 1  # of pivots after the first, before outsiders meet everyone left to meet
SPREAD = 5.0  # standard deviations allowed for when sketches stand for sets

_SKETCHED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()),
                       ("digest", pa.binary()), ("sketch", pa.list_(pa.int64()))])


def shingle_set(code: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles of one text, given the hashes of its words."""
    if len(code) == 0:
        return np.zeros(0, np.int64)
    return np.unique(shingle_codes(code, min(size, len(code))).view(np.int64))


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    for lo, hi, w in word_chunks(batch.column("text")):
        for i in range(hi - lo):
            yield shingle_set(w.code[w.first[i]:w.first[i + 1]], size)


def _digest(s: np.ndarray) -> bytes:
    s = s.view(np.uint64)
    turned = (s ^ (s >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return np.array([s.sum(dtype=np.uint64), (turned ^ (turned >> np.uint64(32))).sum(dtype=np.uint64)],
                    np.uint64).tobytes()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def sketches(docs: DataFrame, k: int = SKETCH, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n (set size), digest of the set, and the k smallest values of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch, size))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                _lists([s[:k] for s in sets])], schema=_SKETCHED)

    return _keyed(docs).mapInArrow(
        tidy(run), "doc_id long, text_key long, n long, digest binary, sketch array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")


def _needed(n: Column, k: int, similarity: tuple[int, int], spread: float) -> Column:
    """Values that the sketch of a set of n must share with that of any set at the threshold. Where
    both sets fit into their sketches that is exact, else a bound by the spread of a sample."""
    t = similarity[0] / similarity[1]
    held = F.least(n, F.lit(k))
    sampled = F.floor(held * t - spread * F.sqrt(held * t * (1 - t)))
    return F.greatest(F.lit(1), F.when(n <= int(k * t), F.ceil(n * similarity[0] / similarity[1])).otherwise(sampled))


def _postings(classes: DataFrame, k: int, similarity: tuple[int, int], spread: float) -> DataFrame:
    """(value, cls, n, typical): each class in the lists of its rarest values that another class
    retains; typical is the mean number of classes that retain a value of its sketch."""
    held = classes.select("cls", "n", F.explode("sketch").alias("value"))
    counts = held.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = held.join(counts, "value").groupBy("cls").agg(
        F.first("n").alias("n"), F.sum("df").alias("dfs"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("rare"))
    total = F.least("n", F.lit(k))
    # values that no other class retains come first in the order of rarity
    alone = total - F.size("rare")
    room = F.greatest(F.lit(0), total - _needed(F.col("n"), k, similarity, spread) + 1 - alone).cast("int")
    listed = shared.select("cls", "n", ((F.col("dfs") + alone) / total).alias("typical"), F.slice("rare", F.lit(1), room).alias("rare"))
    return listed.select("cls", "n", "typical", F.explode("rare").alias("r")).select(
        F.col("r.value").alias("value"), "cls", "n", "typical")


def _comparable(a: str, b: str, similarity: tuple[int, int]) -> Column:
    """Sizes that allow the threshold to be met."""
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return low * similarity[1] >= high * similarity[0]


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, similarity: tuple[int, int], spread: float) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out. The k smallest values of both
    sketches together sample the union; those in both sketches are in the intersection."""
    sides = classes.select("cls", "sketch")
    met = (pairs.join(sides.toDF("a", "sa"), "a").join(sides.toDF("b", "sb"), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    t = similarity[0] / similarity[1]
    met = met.select("a", "b", union.alias("u"), F.array_intersect("sa", "sb").alias("c"))
    hits = F.size(F.array_intersect("u", "c"))
    size = F.size("u")
    return met.where(hits >= size * t - spread * F.sqrt(size * t * (1 - t))).select("a", "b")


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, shingles) of the classes ``wanted`` (cls, doc_id, text_key), from the text of one member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("cls"), _lists(list(_sets(batch, size)))],
                                             schema=pa.schema([("cls", pa.int64()), ("shingles", pa.list_(pa.int64()))]))

    found = _keyed(docs).join(wanted, (F.col("text_key") == wanted["rep_key"]) & F.col("doc_id").eqNullSafe(wanted["rep_id"]))
    return found.select("cls", "text").mapInArrow(tidy(run), "cls long, shingles array<long>").dropDuplicates(["cls"])


def _similar(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``pairs`` (a, b) with the size of the intersection, the exact distance, whether they are
    linked, and the shingles that only a has."""
    met = (pairs.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b")
           .select("a", "b", F.size("xa").alias("n"), F.size("xb").alias("m"), F.array_except("xa", "xb").alias("own")))
    met = met.withColumn("i", F.col("n") - F.size("own"))
    union = F.col("n") + F.col("m") - F.col("i")
    return met.select("a", "b", "i", "own", (1 - F.col("i") / union).alias("distance"),
                      (F.col("i") * similarity[1] >= union * similarity[0]).alias("linked"))


def _outsider_pairs(members: DataFrame, groups: DataFrame, similarity: tuple[int, int], nearest: bool) -> DataFrame:
    """Pairs (a, b) to compare yet, from ``members`` (pivot, cls, n, values, distance, i, own). Distances are
    dealt into windows as wide as two linked classes can differ: an outsider meets its own window and
    the two beside it, not the crowd around the pivot. ``nearest``: only one outsider per pivot."""
    width = 1 - similarity[0] / similarity[1] + 1e-9
    roots = groups.toDF("cls", "root")
    marked = (members.join(roots, "cls", "left").join(roots.toDF("pivot", "pivot_root"), "pivot", "left")
              .withColumn("root", F.coalesce("root", "cls")).withColumn("pivot_root", F.coalesce("pivot_root", "pivot"))
              .withColumn("window", F.floor(F.col("distance") / width)))
    marked = stage(marked, "members")
    outside = marked.where("root <> pivot_root")
    if nearest:
        one = outside.groupBy("pivot").agg(F.min(F.struct("distance", "cls")).alias("one"))
        outside = outside.join(one.select("pivot", F.col("one.cls").alias("cls")), ["pivot", "cls"], "left_semi")
    outside = outside.select(
        "pivot", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"),
        F.col("values").alias("va"), F.col("distance").alias("da"), F.col("i").alias("ia"), F.col("own").alias("oa"),
        F.explode(F.array(*[F.col("window") + i for i in (-1, 0, 1)])).alias("window"))
    there = marked.select("pivot", "window", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"),
                          F.col("values").alias("vb"), F.col("distance").alias("db"), "pivot_root", F.col("i").alias("ib"), F.col("own").alias("ob"))
    most = F.least("ia", "ib") + F.size(F.array_intersect("oa", "ob"))
    met = outside.join(there, ["pivot", "window"]).where(
        (F.col("ra") != F.col("rb")) & (F.lit(nearest) | (F.col("rb") == F.col("pivot_root")) | (F.col("a") > F.col("b")))
        & _comparable("na", "nb", similarity) & (F.abs(F.col("da") - F.col("db")) <= width)
        & F.arrays_overlap("va", "vb")
        & (most * sum(similarity) >= (F.col("na") + F.col("nb")) * similarity[0]))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = SKETCH, size: int = SHINGLE,
                    similarity: tuple[int, int] = SIMILARITY, spread: float = SPREAD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked, directly or through others), kept,
    and text_key (xxhash64 of the text, null as empty; with doc_id it leads back to the row).

    Reads ``doc_id`` and ``text`` only. A null or empty text, or one of blanks, has no shingles and
    is linked with nothing. Rows without a doc_id take part; their component_id is the smallest id
    of their group (null if it has none) and they are kept only when the group has no id. Rows with
    the same doc_id count as separate texts. Repeated rows get the same result once per row.
    """
    rows = stage(sketches(docs, k, size), "sketches")
    classes = stage(
        rows.where("n > 0").groupBy("digest", "n").agg(
            F.min("doc_id").alias("smallest"), F.min(F.struct("doc_id", "text_key")).alias("rep"),
            F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("cls"), "*"), "classes")
    lists = stage(_postings(classes, k, similarity, spread), "lists")

    pivots = lists.groupBy("value").agg(F.max(F.struct("typical", "cls")).alias("p"), F.count("*").alias("members"))
    members = stage(
        lists.join(pivots.where("members > 1").select("value", F.col("p.cls").alias("pivot")), "value")
        .groupBy("pivot", "cls").agg(F.first("n").alias("n"), F.collect_set("value").alias("values")), "members")
    wanted = (members.select("cls").distinct().join(classes, "cls")
              .select("cls", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")))
    sets = stage(_whole_sets(docs, wanted, size), "sets")
    stars = stage(_similar(members.select(F.col("cls").alias("a"), F.col("pivot").alias("b")), sets, similarity), "stars")
    links = stars.where("linked").select("a", "b")
    groups = stage(connected(links), "groups")

    placed = members.join(stars.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), "distance", "i", "own"), ["cls", "pivot"])
    for turn in range(ROUNDS + 1):
        pairs = _estimated(_outsider_pairs(placed, groups, similarity, turn < ROUNDS), classes, k, similarity, spread)
        more = stage(_similar(pairs, sets, similarity).where("linked").select("a", "b"), "links")
        groups = stage(connected(groups.toDF("a", "b").unionByName(more)), "groups")

    roots = groups.join(classes.select(F.col("cls").alias("node"), "smallest"), "node")
    named = roots.groupBy("root").agg(F.min("smallest").alias("named"))
    by_class = roots.join(named, "root").select(F.col("node").alias("cls"), "named")
    ids = classes.join(by_class, "cls", "left").select(
        F.col("digest").alias("d"), F.col("n").alias("m"), F.coalesce("named", "smallest").alias("component"))
    out = rows.drop("sketch").join(ids, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("m")), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")
