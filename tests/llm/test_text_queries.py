"""Registered queries against brute force on the smallest test set."""

import collections
import math
import os
import re
import zlib

import numpy as np
import pytest

from tickerpulse.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def get(name):
        if name not in made:
            made[name] = queries.QUERIES[name](spark, SF).toPandas()
        return made[name]

    return get


def _shingles(text):
    w = WORD.findall(text.translate(LOWER))
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def test_near_duplicates(docs, result):
    sets = {d: _shingles(t) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result("op2_near_duplicates").itertuples()}
    assert got == {d: (len(sets[d]), find(d), find(d) == d) for d in docs}


def _encode(name, text):
    from tokenizers import Tokenizer

    if name not in _encode.held:
        _encode.held[name] = Tokenizer.from_file(queries.tokenizer_file(name))
    return _encode.held[name].encode(text, add_special_tokens=False).ids


_encode.held = {}


def test_packing(docs, result):
    got = result("op3_packing")
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]]
    for doc_id, rows in got.sort_values("piece").groupby("doc_id"):
        ids = np.array([*_encode("byte_bpe_50k.json", docs[doc_id]), 0], "<u4")
        n = -(-len(ids) // 2048)
        cuts = [0, *range(len(ids) - 2048 * (n - 1), len(ids) + 1, 2048)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples()] == [
            (k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert set(got.doc_id) == set(docs)
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) * 1.01 + 1


def test_decontamination(spark, docs, result):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items()
             if " ".join(WORD.findall(x.lower())) in " ".join(WORD.findall(t.lower()))}
    got = set(zip(result("op4_decontamination").doc_id, result("op4_decontamination").item_id))
    assert whole <= got
    for d, i in got - whole:  # nearly whole items
        a, b = _shingles(docs[d]), _shingles(items[i])
        assert len(a & b) >= 0.5 * len(b)


def test_token_files(docs, result):
    at, want = 0, []
    for d in sorted(docs):
        ids = np.array([*_encode("word_bpe_49k.json", docs[d]), 1], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = result("op5_token_files").sort_values("doc_id")
    assert [tuple(r) for r in got[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False)] == want


def _trains(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 != 0


def test_base_scores(docs, result):
    count = collections.Counter()
    for d, t in docs.items():
        if _trains(d):
            count.update([*WORD.findall(t.translate(LOWER)), None])
    n, v = sum(count.values()), len(count)
    for r in result("op6_context_tree").itertuples():
        tokens = [*WORD.findall(docs[r.doc_id].translate(LOWER)), None]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            not _trains(r.doc_id), len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_model_beats_bytes_by_chance(result):
    got = result("op6_context_tree")
    assert (got[got.held_out].bits_per_byte.mean()) < 3.0


def test_repetition(docs, result):
    for r in result("op7_repetition").itertuples():
        text = docs[r.doc_id]
        w = WORD.findall(text)
        windows = collections.Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        marked = [False] * len(w)
        for j in range(len(w) - 7):
            if windows[tuple(w[j:j + 8])] > 1:
                marked[j:j + 8] = [True] * 8
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(marked))
        assert r.base_failed == (len(w) < 20 or 100 * sum(marked) > 30 * len(w))
        assert not (r.base_failed and r.kept)
        n = 5
        seen, later = set(), [False] * len(w)
        for j in range(len(w) - n + 1):
            if tuple(w[j:j + n]) in seen:
                later[j:j + n] = [True] * n
            seen.add(tuple(w[j:j + n]))
        share = sum(len(x) for x, m in zip(w, later) if m) / max(1, sum(map(len, w)))
        assert r.coverage_5 == pytest.approx(share)


def test_url_rules(spark, result):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in result("op8_urls").itertuples():
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = host.translate(LOWER)
        assert (r.host, r.path) == (host, path)
        fitting = [x for x in queries.URL_RULES
                   if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fitting, key=lambda x: len(x.host + x.path), default=None)
        if best is None:
            assert r.rule is None and r.verdict == ("allow" if r.allow_score >= 0.5 else "block")
        else:
            assert (r.rule, r.verdict) == (best.host + best.path, best.verdict)


def test_toxicity(spark, result):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = result("op9_toxicity")
    clean = got[got.doc_id.map(lambda d: labels.get(d) == 0)]
    assert clean.rejected.mean() < 0.05
    assert got[["p_contempt", "p_insult", "p_degradation", "p_toxic"]].apply(lambda c: c.between(0, 1).all()).all()


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op10_quality"](spark, sf).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out & got.doc_id.isin(list(labels))]
    assert (held.predicted == held.doc_id.map(labels)).mean() > 0.9
