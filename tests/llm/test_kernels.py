"""The operators' kernels against brute force and the libraries, without Spark."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as model_pb2
from tokenizers import Tokenizer

from hearth.llm import decontam, embeddings, pieces, quality, simhash, suffixes, tokencount, toxicity
from hearth.llm.queries import tokenizer_path

PIECES, WORDS = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "  a  b ", "a\tb\n\nc", "<s> </s> <0x41>", "▁▁x ▁", "日本語 テキスト", "áé é", "😀 x😀", "İstanbul ŉ ſ µ ªº½",
       "it's we'LL <|endoftext|> <|ENDOFTEXT|>x", "x" * 3000, "\x00\x1f\x85\xa0", "Σίσυφος ΣΑΣ", "…—“q”"]


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_chunks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_block_masks_meet():
    rng = random.Random(1)
    masks = [m % (1 << 64) for m in simhash._masks(2)]
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & m == b & m for m in masks)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def check_encoding(library, text):
    enc = pieces.encoder(PIECES)
    ids, start, end = enc.encode(text)
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert enc.decode(ids) == library.decode(library.encode(text, add_bos=True, add_eos=True))
    raw = text.encode()
    inner = list(zip(start.tolist(), end.tolist(), strict=True))[1:-1]
    assert b"".join(raw[a:b] for a, b in inner) == raw  # spans tile the source
    proto = library.encode(text, return_type="proto")
    for (a, b), piece in zip(inner, proto.pieces, strict=True):
        if not library.is_byte(piece.id):
            assert (a, b) == (piece.begin, piece.end)


@pytest.mark.parametrize("text", ODD)
def test_pieces_odd(library, text):
    check_encoding(library, text)


@given(st.text(alphabet=st.one_of(st.sampled_from("ab  ▁\n.é日😀"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=200, deadline=None)
def test_pieces(text):
    check_encoding(pieces.encoder(PIECES).lib, text)


def test_character_map():
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = model_pb2.ModelProto()
    spec.ParseFromString(lib.serialized_model_proto())
    cmap = pieces.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    for rules in (pieces.Rules(False, False), pieces.Rules(True, False)):
        for text in [*ODD[1:], "ＡＢＣ ①  ﬁ x", "ｶﾞ㌔ ½ ㍿", "é Å"]:
            if "\x00" in text:
                continue
            out, source = pieces.normalise(text, cmap, rules)
            want = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=rules.dummy_prefix, remove_extra_whitespaces=False,
                                                         escape_whitespaces=False).normalize(text)
            assert out.decode() == want.replace(pieces.SPACE_MARK, " ")
            assert len(source) == len(out) + 1 and source[-1] == len(text.encode()) and (np.diff(source) >= 0).all()


@pytest.fixture(scope="module")
def words_library():
    return Tokenizer.from_file(WORDS)


@given(st.text(alphabet=st.one_of(st.sampled_from("ab' st1.!é\n<|>"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=200, deadline=None)
def test_token_counts(text):
    lib = tokencount.counter(WORDS)
    assert lib.by_word
    assert lib.count(text) == len(lib.lib.encode(text, add_special_tokens=False))


def test_token_counts_odd(words_library):
    for text in ODD:
        assert tokencount.counter(WORDS).count(text) == len(words_library.encode(text, add_special_tokens=False)), text


def brute_overlap(texts, items, window):
    found = []
    for d, text in enumerate(texts):
        w = decontam.words_of(text)
        hit, named = set(), set()
        for item, t in items:
            x = decontam.words_of(t)
            k = min(window, len(x))
            for i in range(len(x) - k + 1) if x else ():
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == x[i:i + k]:
                        hit |= set(range(p, p + k))
                        named.add(item)
        found.append((len(w), hit, named))
    return found


@given(st.lists(st.lists(st.sampled_from("a b c d zz".split()), max_size=14), min_size=1, max_size=5),
       st.lists(st.lists(st.sampled_from("a b c d".split()), max_size=9), max_size=4))
@settings(max_examples=200, deadline=None)
def test_suffix_search(texts, items):
    texts, items = [" ".join(t) for t in texts], [(i, ", ".join(t)) for i, t in enumerate(items)]
    block = decontam.block_of(items, 3)
    doc, start, item, offset, n, counts = decontam.matches_in(texts, block)
    for d, (size, hit, named) in enumerate(brute_overlap(texts, items, 3)):
        mine = doc == d
        assert counts[d] == size
        assert {p for s, k in zip(start[mine], n[mine], strict=True) for p in range(s, s + k)} == hit
        assert {block.ids[i] for i in item[mine]} == named
        w = decontam.words_of(texts[d])
        for s, i, o, k in zip(start[mine], item[mine], offset[mine], n[mine], strict=True):
            assert w[s:s + k] == decontam.words_of(dict(items)[block.ids[i]])[o:o + k]


def test_anchors_cover_every_window():
    rng = np.random.default_rng(3)
    for texts in ([rng.integers(97, 101, n, dtype=np.uint8).tobytes() for n in (0, 399, 400, 401, 1500, 3000)], [b"a" * 2000, b"ab" * 600]):
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        place, _, first, last = suffixes.anchors(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds)
        windows = [w for a, b in zip(first.tolist(), last.tolist(), strict=True) for w in range(a, b + 1)]
        want = [int(at) + i for at, t in zip(bounds, texts, strict=False) for i in range(len(t) - 399)]
        assert sorted(windows) == want
        assert ((place >= first) | (place >= last)).all() and (place <= first + 400 - suffixes.GRAM).all()


def test_anchors_in_chunks(monkeypatch):
    data = np.random.default_rng(4).integers(97, 100, 5000, dtype=np.uint8)
    bounds = np.array([0, 1800, 5000])
    whole = suffixes.anchors(data, bounds)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    cut = suffixes.anchors(data, bounds)
    spread = lambda x: {(w, int(p)) for p, a, b in zip(x[0], x[2], x[3], strict=True) for w in range(a, b + 1)}
    assert spread(whole) == spread(cut)


@given(st.lists(st.tuples(st.integers(0, 2), st.text("ab", min_size=6, max_size=11), st.integers(0, 5), st.integers(1, 2)), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_repeated_windows(rows):
    """Windows of six bytes at equal places from the anchor, which all windows hold, compared by brute force."""
    rows = sorted((g, t, max(a, len(t) - 6), w) for g, t, a, w in rows)
    group = np.array([g for g, *_ in rows])
    frags = [t.encode() for _, t, _, _ in rows]
    anchor = np.array([a for _, _, a, _ in rows])
    weight = np.array([w for *_, w in rows], dtype=float)
    seen = Counter()
    for g, f, a, w in zip(group, frags, anchor, weight, strict=True):
        for i in range(len(f) - 5):
            seen[g, i - a, f[i:i + 6]] += w
    got = suffixes.repeated_windows(group, frags, anchor, weight, 6)
    for g, f, a, ranges in zip(group, frags, anchor, got, strict=True):
        assert {i for x, y in ranges for i in range(x, y + 1)} == {i for i in range(len(f) - 5) if seen[g, i - a, f[i:i + 6]] >= 2}


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 400, dtype=np.uint8)
    at = rng.integers(0, 380, 60)
    size = np.minimum(rng.integers(0, 40, 60), 400 - at)
    group = np.sort(rng.integers(0, 4, 60))
    order = suffixes.merge_sort(group, at, size, suffixes.Prefixes(data, suffixes._ODD[1]))
    key = lambda i: (group[i], data[at[i]:at[i] + size[i]].tobytes())
    assert [key(i) for i in order] == sorted(key(i) for i in range(60))


def test_tile_links_match_double_precision():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(20, 64))
    v = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape), base + 0.38 * rng.normal(size=base.shape), rng.normal(size=(40, 64))])
    q, scale, error, size = embeddings.quantise(v)
    unit = embeddings._unit(v)
    assert (np.abs(unit @ unit.T - embeddings.product(q, q) * scale[:, None] * scale) <= size[:, None] * error + error[:, None] + 1e-9).all()
    want = (unit @ unit.T >= 0.93) & ~np.eye(len(v), dtype=bool)
    counts, labels, again = embeddings.tile_links(q, scale, error, size, unit, np.ones(len(v), dtype=np.int64), np.zeros(len(v), bool), True, 0.93)
    assert (counts == want.sum(axis=1)).all() and want.sum() > 20
    assert again < 0.2 * len(v) ** 2 / 2  # the bound settles most pairs
    reach = np.linalg.matrix_power((want | np.eye(len(v), dtype=bool)).astype(float), len(v)) > 0
    assert all(labels[i] == np.flatnonzero(reach[i])[0] for i in range(len(v)))


def test_quality_estimates_accuracies():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55])
    cast = np.where(rng.random((4000, 8)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    cast[rng.random(cast.shape) < 0.2] = 0
    counts = Counter(map(tuple, cast.tolist()))
    posterior, rate, prior = quality.estimate(sorted(counts.items()))
    assert abs(prior - truth.mean()) < 0.05
    said = np.array([posterior[tuple(r)] >= 0.5 for r in cast.tolist()])
    assert (said == truth).mean() > 0.93
    assert rate[0, 1, 2] / (rate[0, 1, 2] + rate[0, 1, 0]) > 0.9 > rate[7, 1, 2] / (rate[7, 1, 2] + rate[7, 1, 0])


def test_quality_edges():
    assert quality.votes(None) == quality.votes("") == (-1, *[0] * 7)
    assert quality.estimate([])[0] == {}
    assert quality.fit([], np.zeros(0)).shape == (quality.BUCKETS + 1,)


def test_toxicity_grammar():
    m = toxicity.Model({"idio": 4.0})
    weigh = lambda t: m.features(t)[0]
    assert weigh(None) == weigh("") == weigh("you are kind") == weigh("an unidiomatic phrase") == 0
    plain, aimed = weigh("what an idiot."), weigh("you are an idiot.")
    assert aimed > plain > weigh("that is not an idiot.") > 0
    assert plain > weigh('somebody said "idiot" there.')
    assert weigh("you, i will kill.") > weigh("they kill weeds.") > 0
    assert m.features("idiot. idiot.")[2] > m.features("idiot.")[2]
    assert 0 <= m.score("") < m.score("you idiot " * 50) <= 1


def test_toxicity_fit():
    x = np.array([[0.0, 0, 0, 0]] * 50 + [[2.0, 1, 1, 0]] * 50)
    w = toxicity._fit(x, np.array([0.0] * 50 + [1.0] * 50), 0.1)
    assert toxicity._logistic(np.array([1.0, 0, 0, 0, 0]) @ w) < 0.1 < 0.5 < toxicity._logistic(np.array([1.0, 2, 1, 1, 0]) @ w)
    assert math.isfinite(w.sum())
