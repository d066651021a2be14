"""The forward pass against a sum over all segmentations, expected counts likewise, and held-out
accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id
from millrace.llm.common import fold, table

PIECES = ["▁", "▁a", "▁ab", "a", "b", "ab", "ba", "aba", "bb", "é", "▁bé"]


def segmentations(word):
    """All lists of pieces that make up the word; an unknown letter stands for itself."""
    if not word:
        return [[]]
    out = []
    for n in range(1, len(word) + 1):
        if word[:n] in PIECES or n == 1:
            out += [[word[:n], *rest] for rest in segmentations(word[n:])]
    return out


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(4)
    return language_id.Model(PIECES, ["x", "y"], rng.random((len(PIECES), 2)) * 5)


def log_of(pieces, model, language):
    return sum(model.log_p[PIECES.index(p) if p in PIECES else len(PIECES), language] for p in pieces)


WORDS = ["a", "ab", "abab", "babaab", "bé", "zéa", "ababababab", "b"]


def test_words_sum_over_all_segmentations(model):
    got = language_id.log_words(model.lattice, WORDS, model.log_p)
    for row, word in zip(got, WORDS):
        for language in range(2):
            want = np.log(sum(np.exp(log_of(s, model, language)) for s in segmentations("▁" + word)))
            assert row[language] == pytest.approx(want, rel=1e-12)


def test_expected_counts(model):
    counts = np.arange(1, len(WORDS) + 1)
    got = language_id.expected(model.lattice, WORDS, counts, model.log_p[:, 1:]) / language_id.UNIT
    want = np.zeros(len(PIECES) + 1)
    for word, n in zip(WORDS, counts):
        ways = segmentations("▁" + word)
        p = np.exp([log_of(s, model, 1) for s in ways])
        for way, share in zip(ways, p / p.sum()):
            for piece in way:
                want[PIECES.index(piece) if piece in PIECES else -1] += n * share
    assert np.allclose(got, want, atol=1e-3)


def test_learning_makes_words_likelier(spark):
    rows = [("x", "abab", 9), ("x", "baba", 4), ("y", "bb", 7), ("y", "bé", 2)]
    words = spark.createDataFrame(rows, "lang string, word string, n long")
    likely = []
    for rounds in range(4):
        model = language_id.learn(words, PIECES, rounds)
        each = language_id.log_words(model.lattice, [w for _, w, _ in rows], model.log_p)
        likely.append(sum(n * each[i, model.languages.index(l)] for i, (l, _, n) in enumerate(rows)))
    assert likely[0] < likely[1] < likely[2] <= likely[3] + 1e-3


def test_words_of():
    assert language_id.words_of("Héllo m²x ½ 9a_b Ⅷ 中文") == ["héllo", "m", "x", "a", "b", "中文"]
    assert language_id.words_of("y" * 150) == ["y" * 64, "y" * 64, "y" * 22]
    assert language_id.words_of("12 -- ²") == []


def test_memory_of_words_is_bounded(model, monkeypatch):
    monkeypatch.setattr(language_id, "HELD_WORDS", 5)
    scorer = language_id.Scorer(model)
    for batch in (["a b ab", "ba"], ["abab baba", "a"], ["aa bb ab ba aab bba"], [None, "", "7"]):
        got, n = scorer.log_texts(batch)
        for row, text in zip(got, batch):
            words = language_id.words_of(text or "")
            assert np.allclose(row, language_id.log_words(model.lattice, words, model.log_p).sum(0))
        assert len(scorer.place) <= 6


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.identify(docs, fold("doc_id", 4) == 2).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    text = "der hund und die katze " * 5
    rows = [(i, text, "de", 1) for i in range(20)] + [(i, "the dog and the cat " * 5, "en", 1) for i in range(20, 40)]
    rows += [(None, None, "de", 1), (None, "und die", None, 1), (50, "", None, 1), (51, "12 ² --", "fr", 1), (52, "ü" * 100_000, None, 1), (1, text, "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    held_out = fold("doc_id", 4) == 2
    got = language_id.identify(docs, held_out).collect()
    assert len(got) == len(rows)
    for r in got:
        want = {50: "und", 51: "und"}.get(r.doc_id, "en" if r.doc_id is not None and 20 <= r.doc_id < 40 else "de")
        if r.doc_id is not None and r.doc_id != 52:
            assert r.lang_pred == want, r
        assert (r.score == 0) == (r.lang_pred == "und")
    unknown = sorted(r.lang_pred for r in got if r.doc_id is None)
    assert unknown == ["de", "und"]
    # Nothing to learn from: every text is undetermined.
    nothing = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")), held_out).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == len(rows)
    assert language_id.identify(docs.where(F.lit(False)), held_out).count() == 0
