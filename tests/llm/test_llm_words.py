"""Hashes of words, and blocks of texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vendaria.llm import setjoin, words
from vendaria.llm.line_dedup import repeated_lines
from vendaria.llm.ngram_join import ngram_components
from vendaria.llm.words import hashed_words, words_of


def mirrored(n):
    """A word of Thue and Morse and its mirror: sums of powers of an odd factor cannot tell long ones apart."""
    ones = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in ones), "".join("ba"[b] for b in ones)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab é\n\t\x00\U0001f600", max_size=40), max_size=6), st.booleans())
def test_equal_words_have_equal_hashes_and_others_do_not(texts, lower):
    found = hashed_words(texts, lower)
    spelt = [w for t in texts for w in words_of(t, lower)]
    assert len(spelt) == len(found.token)
    by_word = dict(zip(spelt, found.token.tolist()))
    assert [by_word[w] for w in spelt] == found.token.tolist()
    assert len(set(by_word.values())) == len(by_word)
    assert found.text.tolist() == [i for i, t in enumerate(texts) for _ in words_of(t)]


@pytest.mark.parametrize("n", [8, 16, 64, 65, 1024, 4096])
def test_words_of_a_known_pattern_stay_apart(n):
    assert len(set(hashed_words([*mirrored(n), "a" * n, "b" * n]).token.tolist())) == 4


def test_long_words_that_differ_in_one_byte():
    rng = random.Random(1)
    base = "".join(rng.choice("abcd") for _ in range(300))
    near = [base[:i] + "x" + base[i + 1 :] for i in range(300)] + [base[:i] for i in range(1, 301)]
    assert len(set(hashed_words(near).token.tolist())) == 600
    # The words before and behind do not matter.
    alone = [hashed_words([w]).token[0] for w in near]
    assert hashed_words([f"q {' '.join(near)} z"]).token[1:-1].tolist() == alone


def test_joins_keep_such_words_apart(spark):
    one, two = mirrored(1024)
    rest = " ".join(f"w{k}" for k in range(3))
    docs = spark.createDataFrame([(1, f"{one} {one}b {rest}"), (2, f"{two} {two}b {rest}"), (3, one), (4, two)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert {r.doc_id: list(r.removed) for r in repeated_lines(docs).collect()} == {1: [], 2: [], 3: [], 4: []}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("aé", max_size=9), st.one_of(st.none(), st.text("b", max_size=9))), max_size=20), st.integers(1, 12))
def test_blocks_hold_all_rows(rows, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(setjoin, "BLOCK_CHARS", size)
        patch.setattr(setjoin, "BLOCK_SETS", 4)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows))), *[pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]], ["n", "one", "two"]
        )
        parts = list(setjoin.blocks(iter([batch]), "one", "two"))
    assert [n for part, _, _ in parts for n in part.column("n").to_pylist()] == list(range(len(rows)))
    assert [(a, b) for _, one, two in parts for a, b in zip(one, two)] == [(a, b or "") for a, b in rows]
    assert all(len(one) <= 4 and (len(one) == 1 or sum(map(len, one + two)) <= size) for _, one, two in parts)


def test_hash_of_no_words():
    assert hashed_words([]).token.dtype == hashed_words(["", " "]).token.dtype == np.uint64
    assert words.hashes(np.zeros(8, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).shape == (0,)
