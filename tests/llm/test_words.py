"""Vectorised word splitting against regular expressions."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from perkline.llm import words

from .data import LETTERS, WORD, lower

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \t\n.<|é中\u00a0\x0b-", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_hashes(texts, limit):
    for table, rx, fold in (
        (words.NON_SPACE, WORD, lower),
        (words.LETTER_DIGIT, LETTERS, lower),
        (words.NON_SPACE_EXACT, WORD, lambda t: t or ""),
    ):
        got, hashes = [], {}
        for a, b, w in words.split(pa.array(texts, pa.string()), table, limit):
            for i in range(b - a):
                found = [w.text(j).decode() for j in range(w.first[i], w.first[i + 1])]
                got.append(found)
                for j, x in zip(range(w.first[i], w.first[i + 1]), found, strict=True):
                    assert hashes.setdefault(int(w.hash[j]), x) == x
        assert got == [rx.findall(fold(t)) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_grams_stay_in_their_text(texts, n):
    for _, _, w in words.split(pa.array(texts, pa.string()), words.NON_SPACE):
        grams, whole = w.grams(n)
        seen = {}
        for i in range(len(w.first) - 1):
            for p in range(w.first[i], w.first[i + 1]):
                assert bool(whole[p]) == (p + n <= w.first[i + 1])
                if whole[p]:
                    key = tuple(w.text(j) for j in range(p, p + n))
                    assert seen.setdefault(int(grams[p]), key) == key
        assert len(set(seen.values())) == len(seen)
