"""File formats and numeric kernels without Spark: round trips, brute force, damage."""

import collections
import io
import itertools
import math
import random
import re
import struct
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerpulse.llm import context_tree, decontaminate, idfiles, packing, quality_model, tokens, toxicity, warc
from tickerpulse.llm.common import word_chunks
from tickerpulse.llm.queries import tokenizer_file


class _Held(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


def _archive(records):
    out = _Held()
    writer = warc.Writer(out)
    for r in records:
        writer.add(r)
    writer.close()
    return out.data


def _pages(n):
    rng = random.Random(3)
    return [warc.record(i, f"http://example.org/{i}", ("<p>" + " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=2000)) + "</p>").encode(), None)
            for i in range(n)]


def test_archive_with_dictionary():
    records = _pages(200)
    data = _archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE and data[8:12] == warc.FRAME
    found = [warc.parse(*f) for f in warc.frames(io.BytesIO(data), size=1000)]
    assert [f.error for f in found] == [None] * 200
    assert [warc.payload_of(f)[3] for f in found] == [None] * 200
    # one frame per record: each decodes on its own
    engine = zstandard.ZstdDecompressor(dict_data=warc.read_dictionary(data[8:8 + size])).decompressobj()
    assert engine.decompress(data[8 + size:]) == records[0]


def test_raw_dictionary_and_none():
    trained = zstandard.train_dictionary(4096, [x[:4000] for x in _pages(100)])
    one = zstandard.ZstdCompressor(dict_data=trained).compress(_pages(1)[0])
    raw = struct.pack("<II", warc.SKIPPABLE, len(trained.as_bytes())) + trained.as_bytes() + one
    assert [warc.parse(*f).error for f in warc.frames(io.BytesIO(raw))] == [None]
    assert [warc.parse(*f).error for f in warc.frames(io.BytesIO(_archive(_pages(2))))] == [None, None]
    assert list(warc.frames(io.BytesIO(b""))) == []


def _frame(data):
    return zstandard.ZstdCompressor().compress(data)


@pytest.mark.parametrize("data, error", [
    (b"HTTP/1.1 200\r\n\r\n\r\n\r\n", "no WARC version line"),
    (b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", "missing"),
    (re.sub(rb"(msgtype=response\r\nContent-Length: )\d+", rb"\g<1>9", warc.record(1, "u", b"abc", None)), "content-length"),
    (warc.record(1, "u", b"abc", None) * 2, "content-length"),
    (warc.record(1, "u", b"abc", None)[:-2], "content-length"),
    (warc.record(1, "u", b"abc", None).replace(b"WARC-Date: ", b"WARC-Date "), "missing warc-date"),
    (warc.record(1, "u", b"abc", None).replace(b"Content-Type: app", b"odd line\r\nContent-Type: app"), "header line"),
])
def test_bad_records(data, error):
    found = [warc.parse(*f) for f in warc.frames(io.BytesIO(_frame(data)))]
    assert found[0].error is not None and error in found[0].error


def test_damage_is_reported():
    whole = _archive(_pages(3))
    assert [e for _, e in warc.frames(io.BytesIO(whole[:-5]))][-1] == "archive ends within a frame"
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 255
    assert any(e for _, e in warc.frames(io.BytesIO(bytes(flipped)))) or any(
        warc.payload_of(warc.parse(d))[3] for d, _ in warc.frames(io.BytesIO(bytes(flipped))))
    changed = warc.record(1, "u", b"abc", None).replace(b"abc", b"abd")
    assert warc.payload_of(warc.parse(changed))[3] == "payload does not match its digest"


def test_record_fields():
    url = "http://x.org/a b\r\nWARC-Type: evil"
    found = warc.parse(warc.record(None, url, b"", 7))
    assert found.error is None and found.fields["warc-type"] == "revisit"
    assert found.fields["warc-refers-to"] == "<urn:page:7>" and "evil" in found.fields["warc-target-uri"]
    assert warc.payload_of(found)[:2] == (0, "da39a3ee5e6b4b0d3255bfef95601890afd80709")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-2**62, 2**62), max_size=700), st.integers(0, 60))
def test_elias_fano(values, shrink):
    values = np.sort(np.array(values, np.int64) >> shrink)
    coded = idfiles.EliasFano.from_bytes(idfiles.EliasFano.encode(values).to_bytes())
    assert coded.all().tolist() == values.tolist()
    assert [coded.select(i) for i in range(len(values))] == values.tolist()
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    assert len(idfiles.EliasFano.encode(ends).to_bytes()) * 8 / len(ends) < 2 + math.log2(1000) + 1


def test_id_file_round_trip():
    docs = [(None, [1]), (None, [5, 1]), (-3, [65535, 1]), (2, [1]), (2, [9] * 3000 + [1]), (10**12, [1])]
    for width in (2, 4):
        out = _Held()
        writer = idfiles.Writer(out, width)
        for doc_id, ids in docs:
            writer.add(doc_id, np.array(ids, "<u4").tobytes())
        writer.close()
        reader = idfiles.Reader(lambda at, n: out.data[at:at + n], len(out.data))
        assert [(d, ids.tolist()) for d, _, ids in reader.scan(tokens=2)] == docs
        assert [(reader.doc_id(i), reader.ids(i).tolist()) for i in range(len(docs))] == docs
    with pytest.raises(ValueError):
        idfiles.Reader(lambda at, n: out.data[at:at + n], len(out.data) - 3)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=list("ab Z09.,!_?|-('s\n\t\r\x0b  é́Σσß<>中🙂‍"), max_size=30))
def test_parts_of_a_text(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own = tokens.encoder(tokenizer_file(name))
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == np.array(want, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1) | st.integers(0, 50), max_size=1200), st.integers(0, 1200), st.integers(0, 1200), st.sampled_from([256, 512, 4096]))
def test_runs_of_boundaries(values, a, b, window):
    values, before = sorted(values), idfiles.WINDOW
    idfiles.WINDOW = window
    try:
        made = idfiles.EliasFano.encode(np.array(values, np.int64))
        back = idfiles.EliasFano.from_bytes(made.to_bytes())
        assert back.all().tolist() == values == [back.select(i) for i in range(len(values))]
        a, b = sorted((min(a, len(values)), min(b, len(values))))
        assert back.run(a, b).tolist() == values[a:b]
    finally:
        idfiles.WINDOW = before


def test_boundaries_take_little_memory():
    """A million sparse numbers: neither writing nor reading them spreads them out."""
    values = np.sort(np.random.default_rng(1).integers(-2**62, 2**62, 1_000_000))
    tracemalloc.start()
    made = idfiles.EliasFano.encode(values)
    data = made.to_bytes()
    del made
    assert tracemalloc.get_traced_memory()[1] < 50e6
    reader = idfiles.EliasFano.from_bytes(data)
    tracemalloc.reset_peak()
    base = tracemalloc.get_traced_memory()[0]
    for first in range(0, len(values), idfiles.WINDOW):
        last = min(first + idfiles.WINDOW, len(values))
        assert np.array_equal(reader.run(first, last), values[first:last])
    assert tracemalloc.get_traced_memory()[1] - base < 5e6
    tracemalloc.stop()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=[c for c in map(chr, range(256)) if tokens._PLAIN.fullmatch(c)], max_size=40))
def test_plain_text_by_its_words(text):
    own = tokens.encoder(tokenizer_file("word_bpe_49k.json"))
    want = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == np.array(want, "<u4").tobytes()


def test_new_words_need_no_call_of_the_whole_tokenizer():
    """Rare words of plain texts are what most of the time went into; case, place and signs beside them make no new ones."""
    own = tokens.Encoder(tokenizer_file("word_bpe_49k.json"))
    untouched, calls = own.tokenizer, []

    class Counting:
        def encode(self, text, **options):
            calls.append(text)
            return untouched.encode(text, **options)

    own.tokenizer = own.parts.tokenizer = Counting()
    text = ", ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}q Ärß{chr(97 + i % 26)} {i}." for i in range(400))
    for x in (text, text.upper().replace("SS", "ß"), text.replace(" ", "\n")):
        assert own.encode(x) == np.array(untouched.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
    assert not calls and len(own.words) < 450
    assert tokens.encoder(tokenizer_file("byte_bpe_50k.json")).words is None


SPECIAL = ("<|endoftext|>", "<|startoftext|>")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*SPECIAL, "<|endoftext", "|>", " ", "  ", "a", "A b", "é.", "\n", "don't", "<|", "9 "]), max_size=12),
       st.sampled_from([3, 1 << 20]))
def test_special_strings_as_the_untouched_tokenizer_takes_them(parts, piece):
    from tokenizers import Tokenizer

    text, before = "".join(parts), tokens.PIECE
    tokens.PIECE = piece
    try:
        for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
            path = tokenizer_file(name)
            if path not in untouched:
                untouched[path] = Tokenizer.from_file(path)
            want = untouched[path].encode(text, add_special_tokens=False).ids
            assert tokens.encoder(path).encode(text) == np.array(want, "<u4").tobytes()
    finally:
        tokens.PIECE = before


untouched = {}


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_prior_is_found_without_bad_texts(share):
    """The share of good rows among the unlabelled ones, from trusted ones alone."""
    rng = np.random.default_rng(5)
    width = quality_model.SHAPES + quality_model.EXTRA

    def drawn(n, shift):
        x = rng.normal(0, 1, (n, width))
        x[:, :40] += shift
        return x

    web = np.concatenate([drawn(int(4000 * share), 1.0), drawn(4000 - int(4000 * share), -1.0)])
    web = rng.permutation(web).astype(np.float32)
    assert abs(quality_model.estimate_prior(drawn(2000, 1.0).astype(np.float32), web) - share) < 0.06
    assert quality_model.estimate_prior(web[:2], web) == 0.5


def test_long_text(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 50)
    own = tokens.encoder(tokenizer_file("byte_bpe_50k.json"))
    text = "One, two  three.\n\nfour's 5 " * 40
    assert own.encode(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=20))
def test_plan_places_every_piece_once(histogram):
    plan = packing.make_plan(histogram, room=32, steps=60)
    used = collections.defaultdict(list)
    for length, n in histogram.items():
        sequence, offset = plan.places(np.full(n, length), np.arange(n))
        for s, o in zip(sequence, offset):
            used[s].append((o, length))
    for places in used.values():
        at = 0
        for o, length in sorted(places):
            assert o == at
            at += length
        assert at <= 32
    assert len(used) == plan.sequences
    least = -(-sum(k * n for k, n in histogram.items()) // 32)
    assert plan.sequences <= least * 1.5 + sum(n for k, n in histogram.items() if k > 16) + 1


def test_best_fit_uses_up_equal_sequences():
    """Every count of two lengths into the sequences that a third left open."""
    for n, m in itertools.product(range(1, 9), range(1, 25)):
        left = np.zeros(33, np.int64)
        left[[20, 5, 2]] = [n, m, m]
        found = collections.Counter()
        for lengths, times in packing._best_fit(left, 32):
            assert times > 0 and sum(lengths) <= 32
            for length in lengths:
                found[length] += times
        assert found == {20: n, 5: m, 2: m}


def test_least_squares_fit():
    counts = np.zeros(17)
    counts[[16, 10, 6, 4, 2]] = [5, 7, 9, 6, 3]
    choices = packing.patterns(counts.astype(int))
    assert all(c.sum() == 16 for c in choices)
    x = packing.fit_repeats(counts, choices, steps=2000)
    a = np.zeros((17, len(choices)))
    for j, c in enumerate(choices):
        for k in c[c > 0]:
            a[k, j] += 1
    weight = np.arange(17) / 16
    gradient = (a * weight[:, None]).T @ ((a @ x - counts) * weight)
    assert (x >= 0).all() and (gradient >= -1e-4).all() and abs(gradient @ x) < 1e-3


def _items(n, seed=0):
    rng = random.Random(seed)
    words = [a + b for a, b in itertools.product("bcdfghklm", ["a", "eo", "i", "ou", "un"])]
    return [(i, " ".join(rng.choices(words, k=rng.randint(3, 30)))) for i in range(n)]


def test_block_max_wand_finds_what_exhaustive_scoring_finds():
    index = decontaminate.build(_items(120))
    rng = random.Random(1)
    for _ in range(200):
        terms = np.array(sorted(rng.sample(range(len(index.word)), rng.randint(1, len(index.word)))))
        score = collections.defaultdict(float)
        for j in terms:
            for k in range(index.at[j], index.at[j + 1]):
                score[int(index.item[k])] += index.weight[k]
        for threshold in (0.2, 0.5, 0.9):
            want = {i: s for i, s in score.items() if s >= threshold - 1e-9}
            got = dict(decontaminate.retrieve(index, terms, threshold))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_bounds_pass_every_hit():
    items = _items(60)
    index = decontaminate.build(items)
    texts = [x for _, x in _items(30, seed=5)] + [items[3][1] + " zz " * 50, "", items[9][1][:20]]
    for _, _, w in word_chunks(pa.array(texts)):
        got = decontaminate.query_texts(index, w, 0.6, 40, 20)
        for i in range(len(texts)):
            code, best = w.code[w.first[i]:w.first[i + 1]], {}
            for s in range(0, max(1, len(code)), 20):
                terms = np.flatnonzero(np.isin(index.word, code[s:s + 40]))
                for item, x in decontaminate.retrieve(index, terms, 0.6):
                    best[item] = max(best.get(item, 0.0), x)
            # passages that start beyond the last full one add nothing new
            assert got.get(i, {}).keys() <= best.keys()
            whole = {j for j, (_, t) in enumerate(items) if t and t in texts[i]}
            ids = {index.items[k].item_id for k in got.get(i, {})}
            assert whole <= ids


def _tree(texts, depth):
    """Context-tree probabilities by definition, node by node."""
    count = collections.defaultdict(lambda: [0, 0])
    below = collections.defaultdict(set)
    for text in texts:
        b = bytes([255] * depth) + text + b"\xff"
        for p in range(depth, len(b)):
            node = 1
            for k in range(7, -1, -1):
                bit = b[p] >> k & 1
                for d in range(depth + 1):
                    count[b[p - d:p], node][bit] += 1
                    if d:
                        below[b[p - d + 1:p], node].add(b[p - d:p])
                node = node * 2 + bit

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def mixed(context, node):
        own = kt(*count[context, node]) if (context, node) in count else 0.0
        if len(context) == depth:
            return own
        return math.log(.5) + np.logaddexp(own, sum(mixed(c, node) for c in below[context, node]))

    def bit_of(recent, d, node, bit):
        context = recent[depth - d:]
        a = count[context, node] if (context, node) in count else [0, 0]
        own = (a[bit] + .5) / (sum(a) + 1)
        if d == depth:
            return own
        stop = math.exp(math.log(.5) + kt(*a) - mixed(context, node))
        return stop * own + (1 - stop) * bit_of(recent, d + 1, node, bit)

    def score(text):
        b, total = bytes([255] * depth) + text + b"\xff", 0.0
        for p in range(depth, len(b)):
            node = 1
            for k in range(7, -1, -1):
                bit = b[p] >> k & 1
                total += math.log10(bit_of(b[p - depth:p], 0, node, bit))
                node = node * 2 + bit
        return total

    return score


def _scores(train, texts, depth):
    def runs(some):
        cuts = np.cumsum([0, *map(len, some)])
        return context_tree.byte_runs(np.frombuffer(b"".join(some), np.uint8), cuts, depth)

    seen, wanted = runs(train)[0], runs(texts)
    code = np.unique(np.concatenate([seen, wanted[0]]))
    n = np.bincount(np.searchsorted(code, seen), minlength=len(code))
    tree = context_tree.Levels(code, n, depth, 2)
    node, zeros, ones, mixed = tree.upper()
    upper, place = np.unique(node & 0xFFFF, return_inverse=True)
    sums = [np.bincount(place, x) for x in (zeros, ones, mixed)]
    value = context_tree.Roof(upper >> 8, upper & 255, *sums).finish(code, tree)
    return np.add.reduceat(value[np.searchsorted(code, wanted[0])], wanted[1][:-1])


def test_context_tree_by_definition():
    train, texts = [b"abracadabra", b"", b"abc abc"], [b"abra", b"", b"zab", "é".encode()]
    for depth in (2, 3, 4):
        score = _tree(train, depth)
        assert _scores(train, texts, depth) == pytest.approx([score(t) for t in texts])


def test_context_tree_is_a_distribution():
    """Over the next byte, probabilities add up to 1."""
    code = (0x616263 << 8) + np.arange(256)
    tree = context_tree.Levels(code, np.random.default_rng(2).integers(0, 9, 256), 3, 2)
    node, zeros, ones, mixed = tree.upper()
    upper = context_tree.Roof(*np.divmod(node & 0xFFFF, 256), zeros, ones, mixed)
    assert (10 ** upper.finish(code, tree)).sum() == pytest.approx(1)


def test_large_counts_of_the_estimate():
    for a, b in [(0, 0), (3, 0), (5000, 2), (10**6, 10**7)]:
        want = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert context_tree.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_chain_learns_and_uses_earlier_categories():
    rng = np.random.default_rng(4)
    words = [rng.integers(100, 400, 30) for _ in range(600)]
    marks = np.zeros((600, 2), int)
    for i in range(0, 600, 4):
        words[i] = np.append(words[i], 7)
        marks[i] = 1
    rows = [np.unique(w).astype(np.uint64) for w in words]
    x = toxicity.Sparse(np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows]))))
    chain = toxicity.fit_chain(x, marks, ("word", "toxic"), np.arange(600) % 5, np.array([7], np.uint64))
    assert chain.models[1].earlier[0] > 0.1
    got = chain.score(x)
    assert ((got[:, -1] >= chain.threshold) == marks[:, 1].astype(bool)).mean() > 0.99
    assert toxicity.fit_chain(x.rows(np.arange(0)), np.zeros((0, 2)), ("a", "b"), np.zeros(0, int), np.zeros(0, np.uint64)).threshold > 1


def test_toxic_words_in_other_forms():
    same = [next(iter(toxicity.features(pa.array([t])))).at.tolist() for t in ("idiot", "(Idiot!)", "IDIOT,")]
    assert same[0] == same[1] == same[2]
    a, b = (set(next(iter(toxicity.features(pa.array([t])))).at.tolist()) for t in ("abcdefgh", "abcdefxy"))
    assert len(a & b) == 3  # the beginnings


def test_non_negative_risk_separates():
    rng = np.random.default_rng(8)
    good = rng.normal(0, 1, (400, 6)).astype(np.float32)
    web = np.concatenate([rng.normal(0, 1, (700, 6)), rng.normal(3, 1, (300, 6))]).astype(np.float32)
    model = quality_model.fit(good, web, 0.7)
    right = np.concatenate([model.score(web[:700]) >= 0.5, model.score(web[700:]) < 0.5])
    assert right.mean() > 0.95
    none = quality_model.fit(np.zeros((0, 6), np.float32), web, 0.7)
    assert none.score(web) == pytest.approx(np.full(1000, 0.7), abs=1e-3)
