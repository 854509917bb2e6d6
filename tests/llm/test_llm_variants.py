import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from edge_cases import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from vendaria.llm import registry, variants
from vendaria.llm.variants import BEGIN, END, WORD, group_variants, grams, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    """All words that one inserted, deleted or replaced code point makes."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b}
    out |= {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def plain_counts(docs, every, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(WORD, text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def plain_groups(counts):
    letters = {c for w in counts for c in w}
    near = {w: [v for v in edits(w, letters) if v in counts] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def groups_of(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


WORDS = st.text("abé", min_size=5, max_size=11)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.dictionaries(st.text("abé^$", min_size=2, max_size=3), st.integers(1, 50)), st.data())
def test_every_near_word_is_in_a_list(word, frequent, data):
    near = sorted(w for w in edits(word, "abéx") if len(w) >= 5)
    other = data.draw(st.sampled_from(near))
    a, b = sorted((word, other), key=lambda w: (len(w), w))
    probes = set(variants._probe_keys(f"{BEGIN}{a}{END}", frequent, 1))
    assert probes & set(variants._index_keys(f"{BEGIN}{b}{END}", frequent, 1))
    assert len(probes) <= 4


@settings(max_examples=200, deadline=None)
@given(WORDS, st.dictionaries(st.text("abé^$", min_size=2, max_size=3), st.integers(1, 50)))
def test_grams_cover_the_word(word, frequent):
    places = grams(word, frequent)
    assert {i for a, b in places for i in range(a, b)} == set(range(len(word)))
    assert all(a < c and b < d for (a, b), (c, d) in zip(places, places[1:]))
    assert all(2 <= b - a <= 4 for a, b in places)


def test_same_groups_as_plain_comparison(spark):
    rng = np.random.default_rng(11)
    spelt = {"".join(rng.choice(list("abcé"), rng.integers(5, 9))) for _ in range(1500)}
    counts = {w: int(n) for w, n in zip(sorted(spelt), rng.geometric(0.02, len(spelt)))}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = plain_groups(counts)
    assert groups_of(group_variants(rows)) == expected
    assert sum(e[0] is not None for e in expected.values()) > 100
    assert any(e[0] != e[1] and e[0] is not None for e in expected.values())


def test_ties_and_chains(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aaacb": 12, "aabbb": 24, "zzzzz": 5, "zzzzÿ": 10, "zzzza": 10}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = groups_of(group_variants(rows))
    assert got == plain_groups(counts)
    assert got["aaaaa"][:2] == ("aaaab", "aabbb") and got["aaaab"][0] == "aaabb" and got["zzzzz"][0] == "zzzza"


def test_query_same_as_plain_comparison(spark, tmp_path):
    docs = [(k, prose(120, k) + " Straße ÀÉîõ÷×ÿ naïve-Naïve o'clock") for k in range(150)]
    docs += [(200, None), (201, ""), (202, "123 !?"), (None, "Wizard" * 40 + " wizards wizardz wizardz wizardz")]
    docs += [(203, "wizards " * 20 + "İſć xé́y" + "漢字" * 3), (203, "wizards " * 20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = groups_of(registry.op12_spelling_variants(spark, str(tmp_path)))
    assert got == plain_groups(plain_counts(docs, 97))
    assert any(g[0] is not None for g in got.values())


def test_counts_of_long_words_and_typos(spark):
    docs = [(k, f"{'ab' * k} {'É' * (k % 50)} abcde") for k in range(1, 120)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    for every in (None, 2, 3):
        got = {r.word: r.n for r in word_counts(rows, min_count=1, typo_every=every).collect()}
        assert got == plain_counts(docs, every, min_count=1)


def test_words_of_a_slice():
    texts = pa.array(["skipped", "Éa bÀ", "", "÷c9d"], pa.large_string())[1:]
    found = variants.words(texts)
    assert found.words.to_pylist() == ["Éa", "bÀ", "÷c", "d"]
    assert found.offsets.tolist() == [0, 2, 2, 4]


def test_edge_cases(spark):
    docs = documents(spark)
    counted = word_counts(docs)
    assert {r.word for r in counted.collect()} == set(plain_counts([(r.doc_id, r.text) for r in docs.collect()], None))
    assert group_variants(word_counts(docs.limit(0))).count() == 0
    assert group_variants(counted).count() == counted.count()
