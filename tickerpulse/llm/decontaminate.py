"""Test items found in training text: BM25 retrieval by block-max WAND, then a check of the words.

Test items are the indexed side, passages of training documents the queries. A word's weight for an
item is its BM25 impact divided by the impact of all words of the item, so an item scores 1 when
a passage holds all of its words, whatever its length. Every passage of every document is a query; all
items at or above ``THRESHOLD`` are retrieved, not the best few.

Bounds save work and lose nothing. Items are numbered by length, so that a block of them holds like
weights. For all passages of a piece of text at once, numpy sums by block the largest weights of the
rarer words; frequent words add at most what they weigh in any one item of the block. Most passages
end there. What is left goes through WAND, by the largest weights of whole posting lists and then of
blocks.

A retrieved item counts when its question and its answer are found in the document: shares of their
runs of words (``RUN`` words, fewer for a shorter part) that occur there. One altered word costs a part
of under ``SHORT`` words more runs than it may miss, so such a part is also held against the text word
by word, in the place where the runs of the other part put it; the larger share counts. Case (in all
scripts) and signs at the ends of words do not matter.

The index is built in blocks of items of bounded size (``ITEMS_PER_BLOCK``); each block is sent to
the tasks, and all documents are queried against every block, so any number of items is covered.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, shingle_codes, text_chunks, tidy, word_chunks

K1, B = 1.2, 0.75
PASSAGE, STEP = 120, 60  # words of a passage, and words from one to the next
THRESHOLD = 0.6
RUN = 5
OVERLAP = 0.6  # share of the runs of question and of answer
SHORT = 17  # of 13 runs a word is in 5: from here on one altered word leaves OVERLAP of them
SLACK = 1  # words that a word may be off its place
GLUED = 4  # bytes; a word at least as long is also found with something glued to it
BLOCK = 16  # items
ITEMS_PER_BLOCK = 2_048  # items of one index
FREQUENT = 50  # a word in more than one of so many items (and in more than two) is frequent


class Item(NamedTuple):
    item_id: int
    code: np.ndarray  # hashes of all words, in order
    text: list[bytes]  # the words
    cut: int  # words of the question


class Index(NamedTuple):
    """Postings by word: word j has the items ``item[at[j]:at[j + 1]]`` (ascending) and their weights."""

    items: list[Item]
    word: np.ndarray
    at: list[int]
    item: list[int]
    weight: list[float]
    most: np.ndarray  # largest weight of each word
    blocks: list[dict[int, float]]  # by word: block of items -> largest weight in it
    longest: int
    rare_at: np.ndarray  # postings of the rarer words by block: word j has rare_at[j]:rare_at[j + 1]
    rare_block: np.ndarray
    rare_most: np.ndarray
    frequent: np.ndarray  # by block: what all frequent words together weigh in one item at most


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: what is before and after the last line end inside the text; an item of
    one line is all question."""
    head, _, tail = text.strip().rpartition("\n")
    return (head, tail) if head else (tail, "")


def plain(texts: pa.Array) -> pa.Array:
    """Lower case, without the signs at either end of words that hold a letter or digit."""
    out = pc.utf8_lower(texts)
    out = pc.replace_substring_regex(out, r"([\pL\pN\pM])[^\pL\pN\pM\t-\r ]+([\t-\r ]|$)", r"\1\2")
    return pc.replace_substring_regex(out, r"(^|[\t-\r ])[^\pL\pN\pM\t-\r ]+([\pL\pN\pM])", r"\1\2")


def plain_chunks(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """``word_chunks`` of the plain texts."""
    for at, to, _, _ in text_chunks(column):
        for lo, hi, w in word_chunks(plain(column.slice(at, to - at))):
            yield at + lo, at + hi, w


def read_items(rows: list[tuple[int, str | None]]) -> tuple[list[Item], list[np.ndarray]]:
    """Items that have a word, in order of id; and the hashes of all their words."""
    rows = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (r[0], r[1]))
    parts = [part for _, text in rows for part in split_item(text)]
    codes, texts = [], []
    for lo, hi, w in plain_chunks(pa.array(parts, pa.string())):
        for i in range(hi - lo):
            own = slice(w.first[i], w.first[i + 1])
            codes.append(w.code[own])
            texts.append([w.buf[a:b].tobytes() for a, b in zip(w.start[own], w.end[own])])
    items, words = [], []
    for k, (item_id, _) in enumerate(rows):
        q, a = codes[2 * k:2 * k + 2]
        whole = np.concatenate([q, a])
        if len(whole):
            items.append(Item(item_id, whole, texts[2 * k] + texts[2 * k + 1], len(q)))
            words.append(whole)
    order = sorted(range(len(items)), key=lambda i: len(words[i]))
    return [items[i] for i in order], [words[i] for i in order]


def build(rows: list[tuple[int, str | None]], statistics: tuple[int, float, dict[int, int]] | None = None) -> Index:
    """``statistics`` over the items of all blocks: their number, mean length, items per word hash."""
    items, words = read_items(rows)
    if statistics is None:
        statistics = item_statistics(words)
    n, mean, having = statistics
    code, item, weight = [], [], []
    for i, whole in enumerate(words):
        own, tf = np.unique(whole, return_counts=True)
        df = np.array([having.get(int(c), 1) for c in own], float)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(whole) / mean))
        code.append(own)
        item.append(np.full(len(own), i))
        weight.append(impact / impact.sum())
    code, item, weight = (np.concatenate(x) if x else np.zeros(0, t) for x, t in
                          ((code, np.uint64), (item, np.int64), (weight, float)))
    order = np.lexsort((item, code))
    code, item, weight = code[order], item[order], weight[order]
    word, at = np.unique(code, return_index=True)
    at = np.append(at, len(code))
    most = np.maximum.reduceat(weight, at[:-1]) if len(word) else np.zeros(0)
    blocks = []
    for j in range(len(word)):
        best: dict[int, float] = {}
        for i, x in zip(item[at[j]:at[j + 1]] // BLOCK, weight[at[j]:at[j + 1]]):
            best[int(i)] = max(best.get(int(i), 0.0), float(x))
        blocks.append(best)
    longest = max((len(x) for x in words), default=0)
    rare = np.diff(at) <= max(2, len(items) // FREQUENT)
    pairs = [sorted(b.items()) if r else [] for b, r in zip(blocks, rare)]
    often = np.zeros(len(items))
    np.add.at(often, item, np.where(np.repeat(rare, np.diff(at)), 0.0, weight))
    frequent = np.array([often[i:i + BLOCK].max() for i in range(0, len(items), BLOCK)])
    return Index(items, word, at.tolist(), item.tolist(), weight.tolist(), most, blocks, longest,
                 np.concatenate(([0], np.cumsum([len(p) for p in pairs]))).astype(np.int64),
                 np.array([b for p in pairs for b, _ in p], np.int64), np.array([x for p in pairs for _, x in p]), frequent)


def item_statistics(words: list[np.ndarray]) -> tuple[int, float, dict[int, int]]:
    if not words:
        return 0, 1.0, {}
    code, df = np.unique(np.concatenate([np.unique(x) for x in words]), return_counts=True)
    return len(words), float(np.mean([len(x) for x in words])), dict(zip(code.tolist(), df.tolist()))


def retrieve(index: Index, terms: np.ndarray, threshold: float, block: int | None = None) -> list[tuple[int, float]]:
    """All (item, score) with a score of at least ``threshold`` for a query of distinct words (places
    in ``index.word``), by block-max WAND: lists are kept in the order of their next item; the pivot
    is the first item at which the largest weights of the lists up to it reach the threshold; it is
    scored only if the largest weights of its block do, too, else the lists skip the block. With
    ``block`` given, among the items of that block."""
    slack = threshold - 1e-9
    words = terms.tolist()
    if block is not None:
        words = [j for j in words if block in index.blocks[j]]
        if sum([index.blocks[j][block] for j in words]) < slack:
            return []
    lists = []  # [next item, word, place, end]
    for j in words:
        lo, hi = index.at[j], index.at[j + 1]
        if block is not None:
            lo = bisect_left(index.item, block * BLOCK, lo, hi)
            hi = bisect_left(index.item, (block + 1) * BLOCK, lo, hi)
        lists.append([index.item[lo], j, lo, hi])
    found = []
    while lists:
        lists.sort(key=lambda x: x[0])
        bound, pivot = 0.0, -1
        for k, entry in enumerate(lists):
            bound += index.most[entry[1]]
            if bound >= slack:
                pivot = k
                break
        if pivot < 0:
            break
        target = lists[pivot][0]
        while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
            pivot += 1
        block = target // BLOCK
        if sum(index.blocks[entry[1]].get(block, 0.0) for entry in lists[:pivot + 1]) < slack:
            # no item of this block up to the next list's item can reach it
            skip = (block + 1) * BLOCK
            if pivot + 1 < len(lists):
                skip = min(skip, lists[pivot + 1][0])
            skip = max(skip, target + 1)
            lists = _advance(index, lists, pivot + 1, skip)
        elif lists[0][0] == target:
            score = sum(index.weight[entry[2]] for entry in lists[:pivot + 1])
            if score >= slack:
                found.append((target, float(score)))
            lists = _advance(index, lists, pivot + 1, target + 1)
        else:
            lists = _advance(index, lists, pivot, target)
    return found


def _advance(index: Index, lists: list[list[int]], count: int, target: int) -> list[list[int]]:
    """The first ``count`` lists move to their first item at or after ``target``."""
    kept = []
    for entry in lists[:count]:
        if entry[0] < target:
            entry[2] = bisect_left(index.item, target, entry[2], entry[3])
            if entry[2] >= entry[3]:
                continue
            entry[0] = index.item[entry[2]]
        kept.append(entry)
    return kept + lists[count:]


def _ragged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges lo[i]:hi[i], and the i of each."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner], owner


def possible(index: Index, place: np.ndarray, known: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             threshold: float) -> list[tuple[int, int]]:
    """(passage, block) of the passages starts[i]:ends[i] of words that may reach the threshold for some
    item of the block."""
    rare = known & (np.diff(index.rare_at)[place] > 0)
    at = np.flatnonzero(rare)
    own = place[at]
    # where the same word stands before: within a passage only its first occurrence counts
    order = np.argsort(own, kind="stable")
    before = np.full(len(at), -1)
    same = own[order][1:] == own[order][:-1]
    before[order[1:][same]] = at[order[:-1][same]]
    out = []
    for lo in range(0, len(starts), 4096):
        s, e = starts[lo:lo + 4096], ends[lo:lo + 4096]
        which, passage = _ragged(np.searchsorted(at, s), np.searchsorted(at, e))
        first = before[which] < s[passage]
        which, passage = which[first], passage[first]
        posting, word = _ragged(index.rare_at[own[which]], index.rare_at[own[which] + 1])
        n = len(index.frequent)
        total = np.bincount(passage[word] * n + index.rare_block[posting], index.rare_most[posting], minlength=len(s) * n)
        own_passage, block = np.nonzero(total.reshape(len(s), n) + index.frequent >= threshold - 1e-6)
        out += zip((own_passage + lo).tolist(), block.tolist())
    return out


def query_texts(index: Index, words: Words, threshold: float, passage: int, step: int) -> dict[int, dict[int, float]]:
    """By text, by item: the best score over all passages of the text."""
    if not len(index.word) or not len(words.code):
        return {}
    place = np.minimum(np.searchsorted(index.word, words.code), len(index.word) - 1)
    known = index.word[place] == words.code
    sizes = np.diff(words.first)
    passages = np.where(sizes > 0, np.maximum(1, -(-(sizes - passage) // step) + 1), 0)
    number, text = _ragged(np.zeros(len(sizes), np.int64), passages)
    starts = words.first[text] + number * step
    ends = np.minimum(starts + passage, words.first[text + 1])
    best: dict[int, dict[int, float]] = {}
    terms, of = np.zeros(0, np.int64), -1
    for k, block in possible(index, place, known, starts, ends, threshold):
        if k != of:
            terms, of = np.unique(place[starts[k]:ends[k]][known[starts[k]:ends[k]]]), k
        for item, score in retrieve(index, terms, threshold, block):
            own = best.setdefault(int(text[k]), {})
            own[item] = max(own.get(item, 0.0), score)
    return best


def overlap(item: Item, words: Words, text: int, memo: dict[int, np.ndarray], least: float = OVERLAP) -> tuple[float, float]:
    """Shares of question and answer that the text holds: of their runs of words or, where that is
    below ``least`` in a short part, of its words in their place. No words: 1."""
    code = words.code[words.first[text]:words.first[text + 1]]
    parts = ((0, item.cut), (item.cut, len(item.code)))
    shares = []
    for lo, hi in parts:
        n = min(RUN, hi - lo)
        if not n:
            shares.append(1.0)
            continue
        if n not in memo:
            memo[n] = shingle_codes(code, n)
        shares.append(float(np.isin(np.unique(shingle_codes(item.code[lo:hi], n)), memo[n]).mean()))
    whole = list(shares)
    for k, (lo, hi) in enumerate(parts):
        if whole[k] < least and hi - lo < SHORT:
            shares[k] = max(whole[k], in_place(item, lo, hi, *parts[1 - k], words, text, memo))
    return shares[0], shares[1]


def in_place(item: Item, lo: int, hi: int, other_lo: int, other_hi: int, words: Words, text: int,
             memo: dict[int, np.ndarray]) -> float:
    """Share of the item's words lo:hi that stand in the text where the runs of the other part (if none
    occurs, single words of the item) put them. One of two words is less than OVERLAP; the adjoining word of the
    other part is added to two."""
    first, last = words.first[text], words.first[text + 1]
    code, n = words.code[first:last], min(RUN, other_hi - other_lo)
    begin = np.zeros(0, np.int64)
    if n:
        begin = _begins(memo[n], shingle_codes(item.code[other_lo:other_hi], n), other_lo)
    if not len(begin):
        begin = _begins(code, item.code, 0)
    if hi - lo == 2 and other_hi > other_lo:
        lo, hi = (lo, hi + 1) if lo < other_lo else (lo - 1, hi)
    if not len(begin):
        return 0.0
    total = np.zeros(len(begin))
    for j in range(lo, hi):
        found = np.zeros(len(begin), bool)
        for off in range(-SLACK, SLACK + 1):
            at = begin + j + off
            inside = np.flatnonzero((at >= 0) & (at < len(code)))
            at = at[inside]
            same = code[at] == item.code[j]
            if not off and len(item.text[j]) >= GLUED:
                same |= _glued(words, at + first, item.text[j])
            found[inside] |= same
        total += found
    return float(total.max() / (hi - lo))


def _begins(have: np.ndarray, want: np.ndarray, shift: int) -> np.ndarray:
    """Where the item begins in the text, by each place of ``want[k]``, which is at ``shift + k`` of the item."""
    at = [np.flatnonzero(have == x) - shift - k for k, x in enumerate(want)]
    return np.unique(np.concatenate(at))


def _glued(words: Words, at: np.ndarray, text: bytes) -> np.ndarray:
    """Whether the words at ``at`` begin or end with ``text``."""
    start, end, n = words.start[at], words.end[at], len(text)
    head = end - start >= n
    tail = head.copy()
    for k, byte in enumerate(text):
        head &= words.buf[np.where(head, start + k, 0)] == byte
        tail &= words.buf[np.where(tail, end - n + k, 0)] == byte
    return head | tail


def _blocks(spark, items: DataFrame, items_per_block: int) -> Iterator:
    """Broadcast indexes of the items, block by block."""
    chosen = items.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    total = chosen.count()
    parts = max(1, -(-total // items_per_block))
    statistics = _all_statistics(chosen) if parts > 1 else None
    for part in range(parts):
        block = chosen if parts == 1 else chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield spark.sparkContext.broadcast(build([tuple(r) for r in block.collect()], statistics))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
          passage: int = PASSAGE, step: int = STEP, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) for every document that holds an item.

    Passages overlap by ``passage - step`` words, and grow with the items of a block: they are never
    shorter than twice its longest item, so that an item lies whole in one of them. One pass over the
    documents holds each text against all blocks. Reads ``doc_id`` and ``text`` of ``docs``, ``item_id``
    and ``text`` of ``items``. Null, empty and blank texts on either side match nothing; items without
    an id are left out; repeated items and rows give a row each; a document without an id gives rows
    with a null id."""
    kind = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    search = _search(list(_blocks(docs.sparkSession, items, items_per_block)), threshold, least, passage, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[row], *found) for row, *found in search(batch.column("text"))]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 *[pa.array(c, pa.float64()) for c in columns[2:]]],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return texts.mapInArrow(tidy(run), kind)


def _all_statistics(items: DataFrame) -> tuple[int, float, dict[int, int]]:
    """Over several blocks: the same sums, block by block through the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, words = read_items(list(zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())))
            own = [np.unique(w) for w in words]
            code = np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64)
            size = np.concatenate([np.where(np.arange(len(o)) == 0, len(w), 0) for o, w in zip(own, words)] or [np.zeros(0, int)])
            head = np.concatenate([np.arange(len(o)) == 0 for o in own] or [np.zeros(0, bool)]).astype(int)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(size), pa.array(head)], names=["code", "size", "head"])

    by_word = items.mapInArrow(tidy(run), "code long, size long, head long").groupBy("code").agg(
        F.count("*").alias("df"), F.sum("size").alias("size"), F.sum("head").alias("items")).toPandas()
    n = int(by_word["items"].sum())
    codes = by_word["code"].to_numpy(np.int64).view(np.uint64).tolist()
    return n, float(by_word["size"].sum()) / max(n, 1) or 1.0, dict(zip(codes, by_word["df"].tolist()))


def _search(shared: list, threshold: float, least: float, passage: int, step: int) -> Callable[[pa.Array], Iterator[tuple]]:
    """What finds (row, item_id, score, question_overlap, answer_overlap) in a column of texts, block by block."""

    def run(texts: pa.Array) -> Iterator[tuple]:
        for lo, hi, w in plain_chunks(texts):
            for held in shared:
                index = held.value
                wide = max(passage, 2 * index.longest)
                stride = max(1, wide * step // passage)
                for i, found in query_texts(index, w, threshold, wide, stride).items():
                    memo: dict[int, np.ndarray] = {}
                    for item, score in sorted(found.items()):
                        question, answer = overlap(index.items[item], w, i, memo, least)
                        if question >= least and answer >= least:
                            yield lo + i, index.items[item].item_id, score, question, answer

    return run


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
          passage: int = PASSAGE, step: int = STEP, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """The rows of ``docs`` whose own text holds no item, whatever their ids."""
    names = docs.columns
    search = _search(list(_blocks(docs.sparkSession, items, items_per_block)), threshold, least, passage, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in search(batch.column(names.index("text"))):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(tidy(run), docs.schema)
