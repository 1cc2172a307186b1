"""Jaccard join of documents on word n-grams by PartEnum signatures.

A document is the set of its distinct three-word shingles (64-bit hashes); documents with equal sets
form a class, named by a 64-bit hash of the set. Sets of sizes n and m that reach the threshold differ
in at most (n + m) * (1 - t) / (1 + t) elements, t being the similarity. The steps:

1. Sizes are cut into bands so narrow that linked sets lie in the same band or in neighbouring ones.
   For each band, and each two neighbours, that bounds the difference by a number k. The domain of the
   hashes is cut into n1 ranges, each again into ``PARTS`` partitions; by the pigeonhole principle the
   sets differ in at most ``DIFFERING`` elements within one of the ranges, so in at most that many of its
   partitions. For every range and every choice of ``PARTS - DIFFERING`` of its partitions a set has
   one signature, the hash of its elements there: two linked sets have one in common.
2. The classes that share a signature meet the largest of them, the pivot, on full sets. Those that
   reach the threshold are linked.
3. What a class has beyond its pivot, and lacks of it, is its delta. Two members of one pivot differ
   in exactly the elements that one of their deltas has and the other has not. A member that is not
   connected with the pivot has a larger delta than it may differ from any other, so it shares
   elements of the delta with whatever it is linked to. Elements that only one component has cannot be
   shared with another; in the order of (several components, rarity), linked members share one of the
   first elements of both deltas (``_first_elements`` says how many). Only members with such an
   element in common, in different components, are compared, by their deltas.

So every pair at the threshold is compared, or known to be connected by links that hold, and neither
copies nor members of a group are written out as pairs of all with all. Signatures are counted by their first
``HEAD`` bits alone; those of several classes are entered in two sets of ``BITS`` bits, which every task gets, so that few of the others
are sent with their class.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BitSet, bit_set, mix, shingle_codes, stage, tidy, word_chunks
from .components import connected

SHINGLE = 3
SIMILARITY = (90, 100)  # links: 100 * intersection >= 90 * union
PARTS = 3  # partitions of a range
DIFFERING = 1  # partitions of a range that are left out
BITS = 1 << 27
WIDTH = 48  # leading bits of a signature that are kept; the others are 0 and cost little on disk
HEAD = 40  # leading bits of a signature by which those of one class are told from the rest
SEEN = 100_000  # classes a task remembers, to send the signatures of its copies once
LARGEST = 1 << 32


@functools.cache
def bands(similarity: tuple[int, int]) -> np.ndarray:
    """The largest size of each band."""
    out, low = [], 1
    while low < LARGEST:
        out.append(low * similarity[1] // similarity[0])
        low = out[-1] + 1
    return np.array(out, np.int64)


def most_different(sizes: int, similarity: tuple[int, int]) -> int:
    """How many elements two linked sets may differ in, given the sum of their sizes."""
    num, den = similarity
    return sizes * (den - num) // (den + num)


def instances(n: int, similarity: tuple[int, int]) -> list[tuple[int, int]]:
    """(number, k) of the signature schemes that a set of size n takes part in: that of its band
    (even numbers) and those with the bands beside it (odd ones), where a partner can lie in them."""
    num, den = similarity
    upper = bands(similarity)
    i = int(np.searchsorted(upper, n))
    out = [(2 * i, most_different(2 * int(upper[i]), similarity))]
    for low in (i - 1, i):  # the lower of two neighbouring bands
        if low >= 0 and (n * den // num > upper[low] if low == i else -(-n * num // den) <= upper[low]):
            top = int(upper[low])
            out.append((2 * low + 1, most_different(top + top * den // num, similarity)))
    return [(number, k) for number, k in out if k > 0]  # different sets differ in one element at least


@functools.cache
def _ranges(count: int) -> np.ndarray:
    """Inner borders of ``count`` equal ranges of 64-bit numbers."""
    return np.array([(i << 64) // count for i in range(1, count)], np.uint64)


def signatures(own: np.ndarray, similarity: tuple[int, int] = SIMILARITY, parts: int = PARTS,
               differing: int = DIFFERING) -> np.ndarray:
    """The signatures of a set (sorted, unsigned)."""
    if not len(own):
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(own))))
    choices = list(itertools.combinations(range(parts), parts - differing))
    out = []
    for number, k in instances(len(own), similarity):
        n1 = -(-(k + 1) // (differing + 1))
        cuts = np.concatenate(([0], np.searchsorted(own, _ranges(n1 * parts)), [len(own)]))
        held = np.diff(sums[cuts]).reshape(n1, parts)
        for c, chosen in enumerate(choices):
            name = (np.arange(n1, dtype=np.uint64) * np.uint64(len(choices)) + np.uint64(c)) << np.uint64(16) | np.uint64(number)
            out.append(mix(held[:, chosen].sum(axis=1, dtype=np.uint64) ^ mix(name + np.uint64(1))))
    return np.concatenate(out) >> np.uint64(64 - WIDTH) << np.uint64(64 - WIDTH) if out else np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    for lo, hi, w in word_chunks(batch.column("text")):
        for i in range(hi - lo):
            code = w.code[w.first[i]:w.first[i + 1]]
            yield np.unique(shingle_codes(code, min(size, len(code)))) if len(code) else np.zeros(0, np.uint64)


def _name(own: np.ndarray) -> int:
    """The class of a set."""
    both = np.array([mix(own).sum(dtype=np.uint64), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    return int(mix(both[:1] ^ mix(both[1:] + np.uint64(len(own)))).view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))


def signed(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY, parts: int = PARTS,
           differing: int = DIFFERING) -> DataFrame:
    """doc_id, row_key, cls, n (set size), signatures and their number (signs). Of the copies of a set that a task meets, only the
    first carries its signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, cls, signs = [], [], []
            for own in _sets(batch, size):
                name = _name(own)
                n.append(len(own))
                cls.append(name)
                signs.append(np.zeros(0, np.uint64) if name in seen else signatures(own, similarity, parts, differing))
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(cls, pa.int64()), pa.array(n, pa.int64()), _lists(signs),
                 pa.array([len(x) for x in signs], pa.int64())], names=["doc_id", "row_key", "cls", "n", "signatures", "signs"])

    return _keyed(docs).mapInArrow(tidy(run), "doc_id long, row_key long, cls long, n long, signatures array<long>, signs long")


def _carriers(rows: DataFrame, bits: int) -> tuple[DataFrame, Broadcast]:
    """(cls, signatures), once for each class. Only rows of classes that several tasks met, and of few others,
    are sent for that. The broadcast holds until the rows are written."""
    several = rows.where("signs > 0").groupBy("cls").agg(F.count("*").alias("carriers")).where("carriers > 1")
    held = rows.sparkSession.sparkContext.broadcast(bit_set(several, "cls", bits))

    def of(copied: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: BitSet = held.value
            for batch in batches:
                cls = batch.column("cls").to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(known.has(cls.view(np.uint64)) == copied))

        return rows.where("signs > 0").select("cls", "signatures").mapInArrow(tidy(run), "cls long, signatures array<long>")

    return of(False).unionByName(of(True).dropDuplicates(["cls"])), held


def _repeated(rows: DataFrame, bits: int) -> DataFrame:
    """(sign): signatures of several classes and few others, cut to their first ``HEAD`` bits. Nearly all have one
    class only, so they are counted without it: next to a random name little would be left to compress."""
    single, held = _carriers(rows, bits)
    head = F.shiftrightunsigned(F.col("sign"), 64 - HEAD)
    heads = single.select(F.explode("signatures").alias("sign")).select(head.alias("head"))
    often = heads.groupBy("head").agg(F.count("*").alias("classes")).where("classes > 1")
    out = stage(often.select(F.shiftleft("head", 64 - HEAD).alias("sign")), "repeated")
    held.destroy()
    return out


def _members(rows: DataFrame, bits: int) -> DataFrame:
    """(pivot, cls): classes that share a signature with a larger one, the largest that has it."""
    repeated, later = _repeated(rows, bits), max(0, HEAD - (bits.bit_length() - 1))
    # by their first and by their last bits: where either set is half full, a quarter of the others pass both
    known = bit_set(repeated, "sign", bits), bit_set(repeated.select(F.shiftleft("sign", later).alias("sign")), "sign", bits)
    held = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = held.value
        for batch in batches:
            signs = batch.column("signatures")
            sizes = pc.list_value_length(signs).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(signs).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(first.has(flat.view(np.uint64)))
            keep = keep[last.has(flat[keep].view(np.uint64) << np.uint64(later))]
            yield pa.RecordBatch.from_pydict({
                "sign": pa.array(flat[keep]),
                **{c: pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes)[keep]) for c in ("cls", "n")}})

    found = stage(rows.where("signs > 0").select("cls", "n", "signatures").mapInArrow(tidy(run), "sign long, cls long, n long"), "found")
    held.destroy()
    # whole numbers order the sizes, fractions the classes of one size
    priority = F.col("n") + F.pmod("cls", F.lit(1 << 20)) / F.lit(float(1 << 20))
    shared = found.groupBy("sign").agg(F.max_by("cls", priority).alias("pivot"), F.min("cls").alias("a"), F.max("cls").alias("b"))
    shared = stage(shared.where("a <> b").select("sign", "pivot"), "shared")
    return stage(found.select("sign", "cls").join(shared, "sign").where("cls <> pivot").select("pivot", "cls").distinct(), "members")


def _wanted_texts(docs: DataFrame, one: DataFrame, bits: int) -> tuple[DataFrame, Broadcast]:
    """(row_key, text) of the rows that ``one`` names, and of few others: these are left out where the texts
    are read, as the join would otherwise send every text. The broadcast holds until the rows are written."""
    held = docs.sparkSession.sparkContext.broadcast(bit_set(one, "row_key", bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: BitSet = held.value
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(known.has(keys.view(np.uint64))))

    return _keyed(docs).select("row_key", "text").mapInArrow(tidy(run), "row_key long, text string"), held


def _whole_sets(docs: DataFrame, rows: DataFrame, members: DataFrame, size: int, bits: int = BITS) -> DataFrame:
    """(cls, shingles, pivots, pivot) of all classes in ``members``, each from one text, written once, with
    the pivots it meets (of its signatures each has one at most) and whether it is one. So a set goes straight to its pivots."""
    ends = [members.select("cls", F.col("pivot").alias("of"), F.lit(False).alias("pivot")),
            members.select(F.col("pivot").alias("cls"), F.lit(None).cast("long").alias("of"), F.lit(True).alias("pivot"))]
    wanted = ends[0].unionByName(ends[1]).groupBy("cls").agg(F.collect_list("of").alias("pivots"), F.max("pivot").alias("pivot"))
    one = stage(rows.groupBy("cls").agg(F.min("row_key").alias("row_key")).join(wanted, "cls"), "wanted")
    texts, held = _wanted_texts(docs, one, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("cls"), _lists(list(_sets(batch, size))), batch.column("pivots"), batch.column("pivot")],
                                             names=["cls", "shingles", "pivots", "pivot"])

    found = texts.join(one, "row_key").dropDuplicates(["row_key"])
    out = stage(found.select("cls", "text", "pivots", "pivot").mapInArrow(
        tidy(run), "cls long, shingles array<long>, pivots array<long>, pivot boolean"), "sets")
    held.destroy()
    return out


def _linked(sizes: Column, different: Column, similarity: tuple[int, int]) -> Column:
    num, den = similarity
    return (sizes - different) * den >= (sizes + different) * num


def _stars(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(pivot, cls) of the members with their size, their delta against the pivot and whether they are linked with it."""
    own = sets.select("cls", F.col("shingles").alias("own"), F.explode("pivots").alias("pivot"))
    whole = sets.where("pivot").select(F.col("cls").alias("pivot"), F.col("shingles").alias("whole"))
    met = own.join(whole, "pivot")
    delta = F.concat(F.array_except("own", "whole"), F.array_except("whole", "own"))
    out = met.select("pivot", "cls", F.size("own").cast("long").alias("n"), (F.size("own") + F.size("whole")).cast("long").alias("sizes"),
                     delta.alias("delta"))
    return out.select("pivot", "cls", "n", "delta", _linked(F.col("sizes"), F.size("delta"), similarity).alias("linked"))


def _first_elements(placed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(pivot, element, cls, n, root, d, outside, at, indexed): the elements of the deltas by which members
    of different components have to be found, with their places in the order; ``indexed`` those that
    count where a member has the smaller delta.

    Two linked members with deltas of d and e share more than (d + e - t) / 2 - 1 elements, if they may
    differ in t. One of them lies outside its pivot's component, so its delta is larger than t and they share more
    than half of the other's. Two sets that share s elements have one in common among the first
    d - s + 1 of the one and e - s + 1 of the other."""
    each = placed.select("pivot", F.explode("delta").alias("element"), "cls", "root")  # no more than is asked for: these rows are sent
    lists = Window.partitionBy("pivot", "element")  # nearly all are short
    mixed = each.select("*", F.count("*").over(lists).alias("df"), F.min("root").over(lists).alias("a"), F.max("root").over(lists).alias("b"))
    rare = mixed.where("a <> b").groupBy("pivot", "cls").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("rare"))
    own = rare.join(placed.select("pivot", "cls", "n", "root", "outside", F.size("delta").alias("d")), ["pivot", "cls"])
    num, den = similarity
    most = F.floor(F.col("n") * (den - num) / num)  # a set of size n may differ from any other in so many
    half = F.ceil(F.col("d") / 2)
    alone = F.col("d") - F.size("rare")  # elements of one component come first
    bigger = F.when(F.col("outside"), most + 1).otherwise(half)
    smaller = F.least(half, F.floor(most / 2) + 1)
    reach = F.greatest(F.lit(0), F.greatest(bigger, smaller) - alone).cast("int")
    listed = own.select("pivot", "cls", "n", "root", "outside", "d", alone.alias("alone"), bigger.alias("bigger"), smaller.alias("smaller"),
                        F.posexplode(F.slice("rare", F.lit(1), reach)).alias("i", "r"))
    at = F.col("alone") + F.col("i")
    return listed.select("pivot", F.col("r.element").alias("element"), "cls", "n", "root", "outside", "d", at.alias("at"),
                         (at < F.col("bigger")).alias("probing"), (at < F.col("smaller")).alias("indexed"))


def _late_links(stars: DataFrame, groups: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) between members of one pivot in different components."""
    roots = groups.toDF("cls", "root")
    placed = (stars.join(roots, "cls", "left").join(roots.toDF("pivot", "pivot_root"), "pivot", "left")
              .withColumn("root", F.coalesce("root", "cls")).withColumn("pivot_root", F.coalesce("pivot_root", "pivot"))
              .withColumn("outside", F.col("root") != F.col("pivot_root")))
    busy = placed.where("outside").select("pivot").distinct()
    placed = stage(placed.join(busy, "pivot", "left_semi").select("pivot", "cls", "n", "delta", "root", "outside"), "placed")
    first = stage(_first_elements(placed, similarity), "elements")

    def renamed(df: DataFrame, x: str) -> DataFrame:
        return df.select("pivot", "element", *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "root", "d", "at")])

    def met(big: DataFrame, small: DataFrame) -> DataFrame:
        sizes = F.col("n_a") + F.col("n_b")
        most = F.floor(sizes * (similarity[1] - similarity[0]) / sum(similarity))
        common = F.greatest(F.lit(1), F.ceil((F.col("d_a") + F.col("d_b") - most) / 2))
        return renamed(big.where("probing"), "a").join(renamed(small.where("indexed"), "b"), ["pivot", "element"]).where(
            (F.col("root_a") != F.col("root_b")) & (F.col("d_a") >= F.col("d_b"))
            & (F.least("n_a", "n_b") * similarity[1] >= F.greatest("n_a", "n_b") * similarity[0])
            & (F.col("at_a") <= F.col("d_a") - common) & (F.col("at_b") <= F.col("d_b") - common)).select("pivot", "cls_a", "cls_b")

    pairs = met(first.where("outside"), first).unionByName(met(first.where("not outside"), first.where("outside"))).distinct()
    deltas = placed.select("pivot", "cls", "n", "delta")
    sides = (pairs.join(deltas.toDF("pivot", "cls_a", "n_a", "delta_a"), ["pivot", "cls_a"])
             .join(deltas.toDF("pivot", "cls_b", "n_b", "delta_b"), ["pivot", "cls_b"]))
    different = F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
    return sides.where(_linked(F.col("n_a") + F.col("n_b"), different, similarity)).select(
        F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
                       parts: int = PARTS, differing: int = DIFFERING, bits: int = BITS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id linked, directly or through others).

    Reads ``doc_id`` and ``text``. A null or empty text, or one of blanks, has no shingles and is
    linked with nothing: its component is its own id. Rows without a doc_id take part; their
    component is the smallest id of their group, or null if it has none. Rows that repeat an id are
    texts of their own, which share that id. Repeated rows get the same result once per row.
    """
    rows = stage(signed(docs, size, similarity, parts, differing), "signed")
    members = _members(rows, bits)
    sets = _whole_sets(docs, rows, members, size, bits)
    stars = stage(_stars(sets, similarity), "stars")
    groups = stage(connected(stars.where("linked").select(F.col("cls").alias("a"), F.col("pivot").alias("b"))), "groups")
    late = stage(_late_links(stars, groups, similarity), "late")
    groups = stage(connected(groups.toDF("a", "b").unionByName(late)), "groups")

    classes = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("smallest"))
    placed = classes.join(groups.toDF("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = placed.groupBy("root").agg(F.min("smallest").alias("component"))
    by_class = placed.join(named, "root").select("cls", "component")
    out = rows.select("doc_id", "n", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
