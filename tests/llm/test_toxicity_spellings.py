"""Hidden spellings of any length are restored."""

import time

import pytest

from spendloom.llm import toxicity


@pytest.fixture(scope="module")
def restorer():
    text = "you stupid idiot and moron are a worthless loser clown with pathetic trash and scum in the old town " * 30
    size = toxicity.SIZE
    return toxicity.Restorer(toxicity.log_probabilities(toxicity.trigram_counts(text).reshape(size, size, size).astype(float)))


def test_spaced_phrases_come_out_as_words(restorer):
    assert restorer.words("y o u i d i o t") == ["you", "idiot"]
    assert restorer.words("1 2 3 4 9") == []
    phrase = "you are a stupid idiot and the old town clown and a worthless moron with trash in the town"
    spaced = " ".join(phrase.replace(" ", ""))
    assert len(spaced) > 2 * 48 and restorer.words(spaced) == phrase.split()


def test_long_runs_of_a_letter(restorer):
    for n in (3, 44, 60, 5000):
        assert restorer.words("idi" + n * "o" + "t") == ["idiot"], n
    assert restorer.words("i" + 70 * "-" + "d-i-o-t") == ["idiot"]


def test_long_joined_tokens(restorer):
    words = ["trash", "town", "clown", "old", "the", "with"] * 5
    for mark in "-,":
        assert "moron" in restorer.words(mark.join([*words, "m0r0n", *words]))


def test_time_is_linear(restorer):
    def took(n):
        start = time.perf_counter()
        restorer.decode("m0r0n-" * n)
        return time.perf_counter() - start

    took(200)
    assert took(8000) < 25 * took(1000)


def test_doubled_letters_share_features():
    assert set(toxicity.word_features("mooron")) >= set(toxicity.word_features("moron"))
    assert set(toxicity.word_features("idiott")) >= set(toxicity.word_features("idiot"))
