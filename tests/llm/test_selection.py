"""Resampling, collocations and the Jaccard join against plain Python, with odd rows and hot keys."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerpulse.llm import collocations, jaccard_join, resampling
from tickerpulse.llm.common import BitSet, spans
from tickerpulse.llm.queries import ship

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, n long, score int, rank string, cls int, prefix string, segment int"
LONG_WORD = "x" * 200
ODD = [(3, None), (4, ""), (5, " \n\t "), (None, "one two three four"), (None, None), (6, "one"), (6, "One two"), (6, "one"),
       (7, f"{LONG_WORD} é{LONG_WORD} {LONG_WORD}"), (8, "word " * 30_000 + "end")]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def _docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, (rest or [None])[0], 1, 2, "r", 3, "p", 4) for i, t, *rest in rows], SCHEMA).repartition(parts)


def _prose(seed, docs, words, vocabulary=60):
    draw = random.Random(seed)
    names = ["".join(draw.choices("abcdeß", k=draw.randint(1, 6))) for _ in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(draw.choices(names, weights, k=draw.randint(0, words)))) for i in range(docs)]


# --- resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]], len(w)


def _resampled(docs, target, percent, buckets, min_words):
    corpus, wanted = collections.Counter(), collections.Counter()
    for _, t, *_ in docs:
        corpus.update(_features(t, buckets)[0])
    for t in target:
        wanted.update(_features(t, buckets)[0])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * (s + buckets) / ((corpus[b] + 1.0) * (t + buckets)))) for b in range(buckets)]
    out = []
    for i, text, *_ in docs:
        f, n = _features(text, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranked = [(*r[:4], k + 1 if k < percent * len(able) // 100 else None) for k, r in enumerate(able)]
    return ranked + [(*r[:4], None) for r in out if r[4] < min_words]


def _got(df):
    return [tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]


def test_resampling_against_plain_python(spark):
    docs = ODD + _prose(1, 400, 60) + [(1000, "the same row")] * 150
    target = ["the same row é", None, "", f"a b {LONG_WORD}", "ab ab cd"]
    items = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    for parts in (1, 7):
        got = _got(resampling.resample(_docs(spark, docs, parts), items, percent=40, buckets=97, min_words=3))
        assert sorted(got, key=str) == sorted(_resampled(docs, target, 40, 97, 3), key=str)


def test_resampling_of_empty_tables(spark):
    none = _docs(spark, [])
    assert resampling.resample(none, none).collect() == []
    got = _got(resampling.resample(_docs(spark, ODD), none, percent=100, min_words=1))
    assert sorted(got, key=str) == sorted(_resampled(ODD, [], 100, 10_000, 1), key=str)


def test_equal_rows_are_split_over_segments(spark):
    """A third of all rows are one row; no segment holds many more rows than another."""
    docs = _docs(spark, _prose(2, 2000, 5) + [(5, "copy of one row")] * 1000, 6)
    runs = resampling._runs(docs, np.zeros(10, np.int64), 3, 0, 7).cache()
    ranked = resampling._ranked(runs, 10).toPandas()
    assert sorted(ranked["rank"]) == list(range(1, 3001))
    sizes = ranked.groupby("segment").size()
    assert len(sizes) == 10 and sizes.max() < 2 * sizes.median()
    assert list(ranked.sort_values("rank")["score"]) == sorted(ranked["score"], reverse=True)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAé0 .-x中", max_size=30) | st.just(LONG_WORD * 2 + " b " + LONG_WORD), max_size=6))
def test_features_are_those_of_zlib(texts):
    found = []
    for first, singles, pairs in resampling._features(pa.array(texts, pa.string()), 10_000):
        for a, b in zip(first[:-1], first[1:]):
            found.append([*singles[a:b].tolist(), *pairs[a:max(b - 1, a)].tolist()])
    assert found == [_features(t, 10_000)[0] for t in texts]


# --- collocations

def _collocations(docs, least, top, longest=4):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        able = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in able.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        rows = []
        for p, a in able.items():
            if 100 * longer[p] < 80 * a:
                s, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def _phrased(seed, docs):
    draw = random.Random(seed)
    fixed = ["new york city hall", "as well as", "in Spite of", "é à", "a a a a a"]
    out = []
    for i, text in _prose(seed, docs, 40, 25):
        words = text.split()
        for _ in range(draw.randint(0, 3)):
            words.insert(draw.randint(0, len(words)), draw.choice(fixed) + draw.choice(["", "", ".", ",\t", "\r\n"]))
        out.append((i, " ".join(words), draw.choice(["en", "en", "en", "fr", None])))
    return out


@pytest.mark.parametrize("bits, spread, parts", [(1 << 16, 3, 1), (64, 1, 4)])
def test_collocations_against_plain_python(spark, bits, spread, parts, monkeypatch):
    """With 64 bits, the set of frequent phrases rules nothing out. All stripes are dealt to places."""
    monkeypatch.setattr(collocations, "HOT", 10**9)
    docs = [(i, t, None) for i, t in ODD] + _phrased(3, 300) + [(9, "same words here again", "en")] * 40
    got = collocations.collocations(_docs(spark, docs, parts), min_count=5, top=40, bits=bits, spread=spread)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == _collocations(docs, 5, 40)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(_docs(spark, [])).collect() == []
    assert collocations.collocations(_docs(spark, [(i, t, None) for i, t in ODD[:7]])).collect() == []


def test_small_blocks_and_long_texts(spark, monkeypatch):
    docs = _phrased(4, 60) + [(7, "one two three. " * 500, "en")]
    made, everything, hot = [], BitSet(np.full(2, 2**64 - 1, np.uint64)), np.zeros(0, np.uint64)
    for limit in (1, 1 << 20):
        monkeypatch.setattr(collocations, "BLOCK_BYTES", limit)
        rows = pa.table({"lang": [d[2] or "und" for d in docs], "text": [d[1] for d in docs]}).to_batches()[0]
        total = collections.Counter()
        for lo, hi, raw, cuts in collocations.text_chunks(rows.column("text"), limit, 1 << 14):
            block = collocations._block(rows.column("lang").slice(lo, hi - lo), raw, cuts, 2, everything, hot, 5)
            for r in block.to_pylist() if block else []:
                for word, n in zip(r["next"].split(" "), r["n"].split(" ")):
                    total[r["lang"], r["prefix"], r["place"], word] += int(n)
        made.append(total)
    assert made[0] == made[1]


# --- Jaccard join

def _shingles(text, size):
    w = SPACED.findall((text or "").translate(LOWER))
    m = min(size, len(w))
    return frozenset(tuple(w[i:i + m]) for i in range(len(w) - m + 1)) if m else frozenset()


def _components(docs, size, num, den):
    sets = [_shingles(t, size) for _, t, *_ in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by[x] if j < i}:
            common = len(s & sets[j])
            if den * common >= num * (len(s) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, *_) in enumerate(docs)), key=str)


def _altered(draw, text, edits):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def _families(seed, families, members, words):
    """Texts, and copies at distances around the threshold, of each other too."""
    draw, out = random.Random(seed), []
    for _ in range(families):
        base = " ".join(f"w{draw.randrange(500)}" for _ in range(draw.randint(5, words)))
        other = _altered(draw, base, max(1, len(base.split()) // 25))  # a second version, near the threshold
        for _ in range(members):
            out.append(_altered(draw, draw.choice([base, other]), draw.randrange(4)))
    draw.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


def _joined(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize("size, similarity, parts, differing, bits",
                         [(3, (90, 100), 3, 1, 1 << 20), (3, (90, 100), 4, 2, 64), (2, (75, 100), 3, 1, 1 << 16), (5, (80, 100), 2, 1, 1 << 16)])
def test_jaccard_join_against_plain_python(spark, size, similarity, parts, differing, bits):
    docs = ODD + [(i + 100, t) for i, t in _families(5, 25, 12, 200)] + [(50, "one row that is there many times")] * 60
    got = jaccard_join.jaccard_components(_docs(spark, docs, 4), size, similarity, parts, differing, bits)
    assert _joined(got) == _components(docs, size, *similarity)


def test_jaccard_join_in_one_large_family(spark):
    """Hundreds of texts whose similarities lie on both sides of the threshold."""
    docs = _families(6, 1, 400, 120) + [(1000 + i, t) for i, t in _families(7, 1, 200, 300)]
    assert _joined(jaccard_join.jaccard_components(_docs(spark, docs, 5))) == _components(docs, 3, 90, 100)


def test_jaccard_join_sends_wanted_texts_only(spark):
    docs = _docs(spark, [(i, f"text number {i} of its own kind") for i in range(2000)], 3)
    keyed = jaccard_join._keyed(docs)
    texts, held = jaccard_join._wanted_texts(docs, keyed.where("doc_id % 100 = 0").select("row_key"), 1 << 20)
    got = {r.text for r in texts.collect()}
    held.destroy()
    assert {f"text number {i} of its own kind" for i in range(0, 2000, 100)} <= got and len(got) <= 25


def test_jaccard_join_counts_signatures_once_for_a_class(spark):
    words = [f"w{i}" for i in range(60)]
    alone, near = " ".join(words), " ".join(["v", *words[1:]])

    def repeated(texts):
        rows = jaccard_join.signed(_docs(spark, list(enumerate(texts)), 1).repartition(4, "doc_id")).cache()
        assert rows.where("signs > 0").count() > rows.select("cls").distinct().count()
        found = {r.sign >> (64 - jaccard_join.HEAD) for r in jaccard_join._repeated(rows, 1 << 20).collect()}
        assert found <= {s >> (64 - jaccard_join.HEAD) for r in rows.collect() for s in r.signatures}
        return found

    assert not repeated([alone] * 40)  # copies that several tasks met
    assert repeated([alone] * 40 + [near] * 40)


def test_jaccard_join_sends_sets_and_deltas_once(spark):
    """A set goes straight to its pivots, and the elements of the deltas once to their like, whatever is counted of them."""
    sets = spark.createDataFrame([(1, [1, 2, 3, 4], [], True), (2, [1, 2, 3, 5], [1], False), (3, [1, 2, 5, 6], [1, 2], False), (4, [7], [], True)],
                                 "cls long, shingles array<long>, pivots array<long>, pivot boolean").withColumn("pivot", F.col("cls") < 3)
    stars = jaccard_join._stars(sets, (60, 100))
    got = {(r.pivot, r.cls): (r.n, sorted(r.delta), r.linked) for r in stars.collect()}
    assert got == {(1, 2): (4, [4, 5], True), (1, 3): (4, [3, 4, 5, 6], False), (2, 3): (4, [3, 6], True)}
    assert len(re.findall(r"Exchange hashpartitioning\(cls", stars._jdf.queryExecution().executedPlan().toString())) == 0

    placed = spark.createDataFrame([(1, 2, 100, [4, 5], 1, False), (1, 3, 100, [4, 5, 9], 3, True), (1, 6, 100, [5, 8], 1, False)],
                                   "pivot long, cls long, n long, delta array<long>, root long, outside boolean")
    first = jaccard_join._first_elements(placed, (90, 100))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(pivot#\d+L?, element", plan)) == 1
    got = {(r.cls, r.element): (r.n, r.root, r.outside, r.d, r["at"]) for r in first.collect()}
    assert got == {(2, 4): (100, 1, False, 2, 0), (3, 4): (100, 3, True, 3, 1), (3, 5): (100, 3, True, 3, 2)}


def test_signatures_are_cut(spark):
    own = np.sort(np.random.default_rng(3).integers(0, 2**64, 300, dtype=np.uint64))
    made = jaccard_join.signatures(own)
    assert len(np.unique(made)) == len(made) > 20 and not np.any(made << np.uint64(jaccard_join.WIDTH))


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(_docs(spark, [])).collect() == []
    lone = [(None, None), (None, ""), (1, " ")]
    assert _joined(jaccard_join.jaccard_components(_docs(spark, lone))) == sorted([(None, 0, None), (None, 0, None), (1, 0, 1)], key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([((90, 100), 3, 1), ((75, 100), 4, 2), ((1, 2), 3, 2)]))
def test_linked_sets_share_a_signature(n, seed, scheme):
    (num, den), parts, differing = scheme
    draw = np.random.default_rng(seed)
    a = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
    gone = draw.integers(0, len(a) // 3 + 2)
    b = np.unique(np.concatenate((draw.permutation(a)[gone:], draw.integers(0, 2**64, draw.integers(0, len(a) // 3 + 2), dtype=np.uint64))))
    common = len(np.intersect1d(a, b))
    if len(b) and den * common >= num * (len(a) + len(b) - common) and not np.array_equal(a, b):
        x, y = (jaccard_join.signatures(s, (num, den), parts, differing) for s in (a, b))
        assert np.intersect1d(x, y).size


# --- shared parts

@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=8), max_size=6))
def test_spans(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    cuts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    start, end, first = spans(raw != 32, cuts)
    joined = "".join(texts)
    got = [[joined[start[j]:end[j]] for j in range(first[i], first[i + 1])] for i in range(len(texts))]
    assert got == [t.split() for t in texts]


def test_bit_set_never_misses():
    codes = np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)
    words = np.zeros(1 << 10, np.uint64)
    empty = BitSet(words)
    at = codes >> empty.shift
    np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    assert at.max() < 64 << 10 and empty.has(codes).all()
    assert empty.has(np.random.default_rng(2).integers(0, 2**64, 10_000, dtype=np.uint64)).mean() < 0.1
