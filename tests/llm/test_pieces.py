"""Sampled segmentations against the full list of segmentations."""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pytest

from gridlake.llm import pieces
from gridlake.llm.pieces import MODEL, Tables, Vocabulary, decode, load_vocabulary, sample_segmentations, segment

with_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")

BYTES = [f"<0x{b:02X}>" for b in range(256)]
PLAIN = ["▁", "a", "b", "c", "▁a", "ab", "bc", "abc", "▁ab", "cc", "▁▁"]


@pytest.fixture(scope="module")
def small():
    names = ["<unk>", *BYTES, *PLAIN]
    weights = [0.0] * 257 + [-1.0 - 0.3 * (i % 4) for i in range(len(PLAIN))]
    return Vocabulary(tuple(names), tuple(weights), (False,) * 257 + (True,) * len(PLAIN), tuple(range(1, 257)), 0)


def all_segmentations(text, vocabulary, byte):
    """Every segmentation of a text with its log weight, as byte strings of ids."""
    spelled = "▁" + text.replace(" ", "▁")
    table = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.usable[i]}
    ways = {0: [((), 0.0)]}
    for end in range(1, len(spelled) + 1):
        ways[end] = []
        for start in range(max(0, end - 16), end):
            piece = spelled[start:end]
            if piece in table:
                i = table[piece]
                ways[end] += [((*ids, i), w + vocabulary.weights[i]) for ids, w in ways[start]]
            elif len(piece) == 1:
                data = piece.encode()
                ids_of = tuple(vocabulary.byte_ids[b] for b in data)
                ways[end] += [((*ids, *ids_of), w + byte * len(data)) for ids, w in ways[start]]
    weights = dict(ways[len(spelled)])
    total = np.logaddexp.reduce(list(weights.values()))
    return {ids: w - total for ids, w in weights.items()}


TEXTS = ["abc", "a", " ", "abcabc ab", "  ab", "xé", "ab\nbc cc", "ccc▁a", "\U0001f600a b"]


def test_samples_are_distinct_paths_with_their_probability(small):
    tables = Tables(small)
    for samples in (1, 3, 40):
        for text, found in zip(TEXTS, segment(TEXTS, list(range(len(TEXTS))), tables, samples), strict=True):
            exact = all_segmentations(text, small, tables.byte)
            ids = [tuple(s.ids.tolist()) for s in found]
            assert len(set(ids)) == len(ids) == min(samples, len(exact))
            perturbed = [s.perturbed for s in found]
            assert perturbed == sorted(perturbed, reverse=True)
            for s, own in zip(found, ids, strict=True):
                assert s.log_probability == pytest.approx(exact[own], abs=1e-9)
                assert decode(s.ids, small) == text.replace("▁", " ")
                assert s.log_inclusion <= 1e-12
            if samples >= len(exact):
                assert all(s.log_inclusion == 0 for s in found)


def test_samples_follow_the_distribution_without_replacement(small):
    tables, text, n = Tables(small), "abc ab", 6000
    exact = all_segmentations(text, small, tables.byte)
    found = [x for a in range(0, n, 500) for x in segment([text] * 500, list(range(a, a + 500)), tables, 2)]
    first = Counter(tuple(f[0].ids.tolist()) for f in found)
    pairs = Counter(tuple(f[1].ids.tolist()) for f in found)
    second = {
        ids: sum(np.exp(exact[o] + w) / (1 - np.exp(exact[o])) for o in exact if o != ids) for ids, w in exact.items()
    }
    for counts, chances in ((first, {i: np.exp(w) for i, w in exact.items()}), (pairs, second)):
        assert sum(chances.values()) == pytest.approx(1)
        statistic = sum((counts[i] - n * p) ** 2 / (n * p) for i, p in chances.items())
        freedom = len(chances) - 1
        assert statistic < freedom + 4 * np.sqrt(2 * freedom)


def test_inclusion_scores_weigh_without_bias(small):
    """Sums of probability / inclusion estimate the whole: 1 on average."""
    tables, text = Tables(small), "abc ab"
    found = segment([text] * 3000, list(range(3000)), tables, 3)
    sums = [sum(np.exp(s.log_probability - s.log_inclusion) for s in f) for f in found]
    assert np.mean(sums) == pytest.approx(1, abs=5 * np.std(sums) / np.sqrt(len(sums)))


def test_samples_depend_on_the_key_only(small, monkeypatch):
    tables = Tables(small)
    text = "abcab cc " * 400
    whole = segment([text, "ab", text], [5, 6, 5], tables, 3)
    alone = segment([text], [5], tables, 3)
    monkeypatch.setattr(pieces, "SPLIT_PLACES", 7)
    split = segment(["bc", text], [9, 5], tables, 3)
    for other in (whole[2], alone[0], split[1]):
        assert [s.ids.tolist() for s in other] == [s.ids.tolist() for s in whole[0]]
        assert [s.perturbed for s in other] == pytest.approx([s.perturbed for s in whole[0]])
    assert [s.ids.tolist() for s in segment([text], [7], tables, 3)[0]] != [s.ids.tolist() for s in alone[0]]


def test_a_single_segmentation(small):
    (found,) = segment(["\n"], [1], Tables(small), 5)
    assert len(found) == 1 and found[0].log_probability == pytest.approx(0)


@with_model
def test_with_a_public_vocabulary():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = load_vocabulary()
    tables = Tables(vocabulary)
    texts = ["Hello world, this is  a test.\n\tNew", "é́ ﬁ ① 漢字 \x00", " leading", "a" * 300, "x" * 5000, "▁ literal"]
    for text, found in zip(texts, segment(texts, [1] * len(texts), tables, 3), strict=True):
        for s in found:
            assert decode(s.ids, vocabulary) == model.decode(s.ids.tolist()) == text.replace("▁", " ")
    lattice = pieces.Lattice([texts[0]], tables)
    edges = {(int(a), int(b)) for a, b in zip(lattice.node, lattice.piece, strict=True)}
    assert len(edges) == len(lattice.node)
    # the library's own encoding is a path
    exact = all_segmentations("test. New", vocabulary, tables.byte)
    assert tuple(model.encode("test. New")) in exact


@with_model
def test_documents(documents, word_text):
    rows = [(1, word_text(60)), (1, word_text(60)), (2, None), (3, ""), (None, "a b"), (4, "漢\U0001f600\n"), (5, "long " * 60000)]
    got = sample_segmentations(documents(rows), load_vocabulary()).collect()
    assert all(r["decoded"] for r in got)
    counts = Counter(r["doc_id"] for r in got)
    assert counts[1] == 4 and counts[2] == counts[3] == 1 and counts[None] == counts[5] == 2
    assert all(r["ids"] == [] and r["perturbed"] is None for r in got if r["doc_id"] in (2, 3))
    assert len({tuple(r["ids"]) for r in got if r["doc_id"] == 1}) == 2
    assert sample_segmentations(documents([]), load_vocabulary()).count() == 0


@with_model
def test_few_hashes_are_looked_up_beyond_the_first_table(monkeypatch):
    tables = Tables(load_vocabulary())
    own = [i for i, usable in enumerate(tables.vocabulary.usable) if usable and tables.vocabulary.pieces[i]]
    texts = [tables.vocabulary.pieces[i] for i in own]
    ends = np.cumsum([len(t) for t in texts])
    codes = np.array([ord(c) for t in texts for c in t], np.int64)
    known = pieces._Hashes(codes).of(ends - [len(t) for t in texts], ends)
    assert tables.find(known).tolist() == own
    looked_up, plain = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, **more: looked_up.append(len(v)) or plain(a, v, **more))
    unknown = np.setdiff1d(np.random.default_rng(3).integers(0, 1 << 63, 100_000, np.uint64), known)
    assert (tables.find(unknown) == -1).all()
    assert sum(looked_up) < len(unknown) / 100
