import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm import arrow_words, registry
from vendaria.llm.decontamination import WINDOW, find_passages, remove, without_passages
from vendaria.llm.decontamination import WORD as BENCHMARK_WORD
from vendaria.llm.fm_index import FmIndex, suffix_array

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(BENCHMARK_WORD, (text or "").translate(LOWER))


def plain(docs, items):
    """(id, number of words, hit places, items) by comparing every place with every window."""
    windows = set()
    for item, text in items:
        own = words(text)
        n = min(len(own), WINDOW)
        windows |= {(item, tuple(own[i : i + n])) for i in range(len(own) - n + 1) if n}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= {str(item)} if item is not None else set()
        out.append((doc_id, len(own), sorted(hit), sorted(found)))
    return out


def found_of(spark, docs, items, **options):
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = []
    for row in find_passages(rows, benchmark, **options).collect():
        hit = [i for s in row.passages.spans for i in range(s.start, s.end)]
        assert all(a.end < b.start for a, b in zip(row.passages.spans, row.passages.spans[1:]))
        out.append((row.doc_id, row.passages.n_words, hit, row.passages["items"]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=30), min_size=1, max_size=5))
def test_index_finds_every_place(stretches):
    symbols = np.array([s for stretch in stretches for s in stretch])
    index = FmIndex(symbols, np.array([len(s) for s in stretches]), 4, sample=3)
    starts = np.cumsum([0, *[len(s) for s in stretches]])
    for length in (1, 2, 5):
        phrases = {tuple(s[i : i + length]) for s in stretches for i in range(len(s) - length + 1)} | {(1,) * length}
        matrix = np.array([[0] * (6 - length) + list(p) for p in phrases])
        low, high = index.search(matrix, np.full(len(matrix), length))
        for phrase, a, b in zip(phrases, low, high, strict=True):
            expected = [
                start + i
                for start, s in zip(starts, stretches, strict=False)
                for i in range(len(s) - length + 1)
                if tuple(s[i : i + length]) == phrase
            ]
            assert sorted(index.locate(np.arange(a, b))) == expected


def test_suffixes_of_long_repeats():
    text = np.array([1, 2] * 500 + [3] * 300 + [0])
    order = suffix_array(text)
    assert [text[i:].tolist() for i in order] == sorted(text[i:].tolist() for i in range(len(text)))


def test_same_as_plain_comparison(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 4, n))
    items = [(1, text(12)), (2, text(30)), (10, "W1, w2-W3"), (None, text(11)), (3, None), (4, " .. "), (2, text(14))]
    items.append((5, items[0][1] + " and more"))
    docs = [(k, f"{text(40)} unknown {items[k % 3][1]}; {text(30)}") for k in range(30)]
    docs += [(90, None), (91, ""), (92, "w1 w2"), (93, "w1 w2 w3"), (94, "?!"), (None, items[1][1]), (95, items[1][1])]
    docs += [(96, "x" * 100_000), (97, " ".join(["w1"] * 5000)), (98, items[3][1]), (98, items[3][1])]
    expected = plain(docs, items)
    assert any(hit for _, _, hit, _ in expected)
    assert sorted(found_of(spark, docs, items), key=str) == sorted(expected, key=str)
    assert sorted(found_of(spark, docs, items, block_windows=7), key=str) == sorted(expected, key=str)


def test_query_same_as_plain_comparison(spark, tmp_path):
    items = [(k, prose(8 + 3 * k, k)) for k in range(12)]
    docs = [(k, f"{prose(20, k + 50)} {items[k % 12][1].upper()} {prose(9, k)}") for k in range(30)] + [(99, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {tuple(r) for r in registry.op13_decontamination(spark, str(tmp_path)).collect()}
    digest = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    assert got == {
        (d, n, len(hit), len(names), digest(names), bool(hit)) for d, n, hit, names in plain(docs, items)
    }


def test_edge_cases(spark):
    docs = documents(spark).withColumn("passages", F.lit("own"))
    benchmark = documents(spark).selectExpr("doc_id AS item_id", "text")
    found = find_passages(docs, benchmark)
    assert found.columns == docs.columns
    assert found.count() == docs.count()
    empty = benchmark.limit(0)
    assert found_of_nothing(find_passages(docs, empty))
    assert find_passages(docs.limit(0), benchmark).count() == 0
    cut = without_passages(docs, benchmark)
    assert cut.columns == docs.columns
    assert cut.schema["text"].dataType == T.StringType()
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == "" and texts[3] is None and texts[4] == "" and texts[5] == " \t\n\x0b\x0c\r "


def found_of_nothing(found):
    return all(not r.passages.spans and not r.passages["items"] for r in found.collect())


@pytest.mark.parametrize(
    ("text", "spans", "left"),
    [("a b, c d!", [(1, 3)], "a  d!"), ("Ab", [(0, 1)], ""), ("é x \U0001f600 y", [(0, 1), (2, 3)], " x  y"), ("a", [], "a")],
)
def test_removed_spans(text, spans, left):
    assert remove(text, spans) == left


def test_blocks_of_bytes(monkeypatch):
    monkeypatch.setattr(arrow_words, "BLOCK_BYTES", 5)
    texts = pa.array(["abc", None, "d", "efghij" * 3, "", "k"])
    parts = list(arrow_words.blocks_of(texts))
    assert [t or "" for t in texts.to_pylist()] == [t for _, b in parts for t in b.to_pylist()]
    assert [start for start, _ in parts] == list(np.cumsum([0, *[len(b) for _, b in parts]])[:-1])
    assert len(parts) > 2
