"""Merge-dropout: the library's own encoding without dropout, exact round trips with it."""

import random

import numpy as np
import pytest
import sentencepiece

from vacantia.llm import pieces
from vacantia.llm.workloads import PIECES

ALPHABET = " \n\t  abcéß漢字🙂\x00<|im>ﬁＡ12'.,-the in▁"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.read(PIECES)


@pytest.fixture(scope="module")
def merger(vocabulary):
    return pieces.Merger(vocabulary)


def texts(seed, number, most, alphabet=ALPHABET):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(number)]


def test_without_dropout_same_as_library(vocabulary, merger):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = texts(1, 800, 90, ALPHABET.replace("▁", ""))
    got = pieces.Encoder(merger, 0, 1).encode(plain)
    assert [x.tolist() for x in got] == [model.encode(t) for t in plain]


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_round_trip_and_repeatable(vocabulary, merger, dropout):
    some = texts(2, 400, 120) + ["x" * 5000, "▁", " ", "\ud800", "", None]
    one = pieces.Encoder(merger, dropout, 7).encode(some)
    assert [vocabulary.decode(x.tolist()) for x in one] == [t or "" for t in some]
    two = pieces.Encoder(merger, dropout, 7).encode(some[::-1])[::-1]
    assert [x.tolist() for x in one] == [x.tolist() for x in two]
    other = pieces.Encoder(merger, dropout, 8).encode(some)
    assert dropout == 1.0 or [x.tolist() for x in one] != [x.tolist() for x in other]


def test_many_words_at_once_same_as_one_by_one(vocabulary, merger):
    words = [w for t in texts(3, 500, 70, "abcdeinthr sm漢") for w in t.split(" ") if w] + ["x" * 70, "inter" * 40]
    keys = np.arange(len(words)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    limit = round(0.2 * (1 << 32))
    got, places = merger.merge(words, keys, limit, traced=True)
    for i, word in enumerate(words):
        own = []
        assert got.values[got.places(np.array([i]))].tolist() == vocabulary.merge(word, int(keys[i]), limit, own)
        assert places.values[places.places(np.array([i]))].tolist() == own


def test_full_cache_changes_nothing(vocabulary, merger, monkeypatch):
    some = texts(4, 200, 200, "abcdeinthr sm")
    want = [x.tolist() for x in pieces.Encoder(merger, 0.1, 1).encode(some)]
    monkeypatch.setattr(pieces.Encoder, "KEEP", 500)
    encoder = pieces.Encoder(merger, 0.1, 1)
    assert [x.tolist() for t in some for x in encoder.encode([t])] == want


def test_kept_bytes_are_bounded(vocabulary, merger, monkeypatch):
    monkeypatch.setattr(pieces.Encoder, "KEEP", 1 << 20)
    encoder = pieces.Encoder(merger, 0.1, 1)
    rng = random.Random(9)
    most = 0
    for _ in range(20):
        encoder.encode([" ".join("".join(rng.choices("etaoinsh", k=9)) for _ in range(2_000))])
        most = max(most, encoder.held)
    assert most < 3 << 20
    encoder.encode(["y" * 100_000])
    assert "y" * 100_000 not in encoder.number


def test_long_words_and_texts(vocabulary, merger, monkeypatch):
    """A word cut where no merge can cross gives the same ids as the whole word; texts in parts too."""
    rng = random.Random(10)
    words = ["".join(rng.choices("abcxyzäß漢字QZ90+/", k=n)) for n in (65, 300, 5_000)] + ["a" * 3_000]
    for word in words:
        for limit in (0, 1 << 30):
            assert vocabulary.merge(word, 77, limit) == vocabulary._agenda(word, 0, len(word), 77, limit, None)
    text = " ".join(words) + "\n" + "the end of it " * 3_000
    want = pieces.Encoder(merger, 0.1, 1).encode([text, "the end"])
    monkeypatch.setattr(pieces.Encoder, "LONG_TEXT", 1_000)
    monkeypatch.setattr(pieces.Encoder, "WORDS", 777)
    got = pieces.Encoder(merger, 0.1, 1).encode([text, "the end"])
    assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_word_of_millions_of_characters(vocabulary, merger):
    for unit in ("漢字仮名", "Zq9+"):
        word = unit * 1_200_000  # beyond 2**22 characters
        ids = pieces.Encoder(merger, 0.1, 1).encode([word, "after it"])
        assert vocabulary.decode(ids[0].tolist()) == word and vocabulary.decode(ids[1].tolist()) == "after it"
    # places beyond 2**21 do not meet
    assert len({pieces.place_of(i, i + 1, i + 2, 1 << 23) for i in range(0, 1 << 23, 997)}) == len(range(0, 1 << 23, 997))


def test_segmentations_vary(vocabulary, merger):
    text = "the international organisation of the government " * 200
    ids = pieces.Encoder(merger, 0.1, 1).encode([text])[0].tolist()
    assert len(ids) > len(pieces.Encoder(merger, 0, 1).encode([text])[0])
    blocks = {tuple(ids[i : i + 20]) for i in range(0, len(ids) - 20)}
    assert len(blocks) > 20


def test_table(spark):
    rows = [(1, "abc def", "k"), (1, "abc def", "k"), (None, None, "k"), (3, "", None), (4, "▁ z\n", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encoded(docs, PIECES)
    found = got.collect()
    assert len(found) == 5 and all(r.lossless and r.n_ids == len(r.ids) for r in found)
    back = pieces.decoded(got, PIECES).collect()
    assert sorted(r.text for r in back) == ["", "", "abc def", "abc def", "▁ z\n"]
    assert pieces.encoded(docs.filter("false"), PIECES).count() == 0


def test_each_occurrence_draws_anew(vocabulary, merger):
    encoder = pieces.Encoder(merger, 0.1, 1)
    ids = encoder.encode(["of" + " of" * 3999])[0].tolist()
    # One piece by "of" or " o" first: none of two merges skipped, or "of" only and none of two others.
    whole = ids.count(vocabulary.ids[" of"])
    assert abs(whole / 4000 - (0.9**2 + 0.1 * 0.9**2)) < 0.03
    common = ["the", "and", "of", "in", "to", "is", "for", "with", "that", "on", "as", "by"]
    text = " ".join(common * 300)
    got = [tuple(x) for x in _by_word(vocabulary, encoder.encode([text])[0].tolist())]
    forms = {w: {x for x, c in zip(got, common * 300) if c == w} for w in common}
    assert all(len(f) > 1 for f in forms.values())


def _by_word(vocabulary, ids):
    out = []
    for i in ids:
        if vocabulary.back[i].startswith(b" "):
            out.append([])
        out[-1].append(i)
    return out


class EveryDraw(pieces.Merger):
    """Takes every occurrence for one that skips a merge, and merges one by one."""

    @staticmethod
    def skipped(keys, places, limit):
        return keys == keys

    def merge(self, words, keys, limit, traced=False):
        if traced:
            return super().merge(words, keys, limit, traced)
        return pieces.Flat.of([self.vocabulary.merge(w, int(k), limit) for w, k in zip(words, keys)], np.int32), None


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_own_draws_same_as_one_by_one(vocabulary, merger, dropout):
    some = texts(5, 300, 150) + texts(6, 100, 200, "abcdeinthr sm") + ["x" * 500, " ", "\ud800", "", None, "▁"]
    encoder = pieces.Encoder(merger, dropout, 7)
    got = encoder.encode(some)
    assert [vocabulary.decode(x.tolist()) for x in got] == [t or "" for t in some]
    # Every occurrence merged by itself under its key, without the short cut for words that skip nothing.
    slow = pieces.Encoder(merger, dropout, 7)
    slow.merger = EveryDraw(vocabulary)
    assert [x.tolist() for x in slow.encode(some)] == [x.tolist() for x in got]
    assert [x.tolist() for t in some[::-1] for x in encoder.encode([t])][::-1] == [x.tolist() for x in got]


def test_many_new_words_in_one_batch(vocabulary, merger):
    text = " ".join(f"ab{i}" for i in range(20_000))
    ids = pieces.Encoder(merger, 0.1, 7).encode([text])[0].tolist()
    assert vocabulary.decode(ids) == text
