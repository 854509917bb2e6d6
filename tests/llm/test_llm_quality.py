import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge_cases import documents, labels, learnable
from hypothesis import given, settings
from hypothesis import strategies as st

from vendaria.llm import cotraining, quality_rules
from vendaria.llm.registry import op1_cotraining, op8_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(st.sampled_from("ab #|\n\t\x0b\x1cé<"), max_size=80)


def brute(text):
    """Words, their characters, symbols, repeated lines, words in repeated windows; counted one by one."""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_counts(texts):
    stats = quality_rules.text_stats(texts)
    assert [tuple(r) for r in stats[list(quality_rules.COUNTS)].to_numpy().tolist()] == [brute(t) for t in texts]


def test_windows_do_not_reach_over_texts():
    texts = ["a b c d e", "a b c d e", "a b c d e a b c d e", None]
    assert quality_rules.text_stats(texts)["n_repeat_words"].tolist() == [0, 0, 10, 0]


def test_flattened_trees_learn_and_keep_to_the_constraints():
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(1500, 3))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 0]) < 0.6) & (x[:, 1] > 0.3) ^ (rng.uniform(size=1500) < 0.05)).astype(float)
    trees = quality_rules.fit_trees(x[:1000], y[:1000], monotone=(-1, 0, 1))
    assert ((trees.score(x[1000:]) > 0.5) == y[1000:]).mean() > 0.9
    grid = np.linspace(-0.5, 1.5, 200)
    for at in rng.uniform(size=(30, 3)):
        for feature, sign in ((0, -1), (2, 1)):
            rows = np.repeat(at[None], len(grid), axis=0)
            rows[:, feature] = grid
            assert (sign * np.diff(trees.log_odds(rows)) >= -1e-12).all()
    free = quality_rules.fit_trees(x[:1000], y[:1000], monotone=(0, 0, 0))
    rows = np.repeat(np.full((1, 3), 0.7), len(grid), axis=0)
    rows[:, 0] = grid
    assert (np.diff(free.log_odds(rows)) > 1e-9).any()  # without the constraint it would rise somewhere


def test_flat_scores_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 4)), rng.integers(0, 2, 300).astype(float)
    t = quality_rules.fit_trees(x, y, monotone=(0, 1, -1, 0), n_trees=7)

    def walk(row):
        total = t.start
        for root in t.roots:
            node = root
            while t.left[node] != node:
                node = t.left[node] if row[t.feature[node]] <= t.threshold[node] else t.right[node]
            total += t.value[node]
        return total

    assert t.log_odds(x) == pytest.approx([walk(r) for r in x])


def test_trees_without_two_labels():
    for y in ([], [1.0] * 20, [0.0] * 20):
        score = quality_rules.fit_trees(np.zeros((len(y), 12)), np.array(y)).score(np.zeros((2, 12)))
        assert (score > 0.5).all() == (not y or y[0] == 1)


def test_rules_edge_cases(spark):
    rows, marks = learnable(120)
    docs = documents(spark, rows + [(1, None, None, None), (2, "", "en", "a"), (2, " \n", "en", "a"), (None, "a b", "en", "a")])
    trees = quality_rules.train(docs, labels(spark, [*marks, (None, 1, 1), (1, None, None), (2, 1, 0)]))
    out = quality_rules.judge(docs, trees).collect()
    assert len(out) == len(rows) + 4
    for row in out:
        words = WORD.findall(row["text"] or "")
        assert row["quality"]["n_words"] == len(words)
        assert not (row["quality"]["kept"] and (len(words) < 10 or row["quality"]["base_failed"]))
        assert row["score"] == "own"
    assert quality_rules.judge(documents(spark, []), trees).count() == 0
    held = [r for r in out if r["doc_id"] and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["doc_id"] >= 1000]
    noisy = {i: q == 0 for i, q, _ in marks}
    assert np.mean([r["quality"]["kept"] != noisy[r["doc_id"]] for r in held]) > 0.9


def test_rules_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op8_quality_rules(spark, sf_dir).toPandas().set_index("doc_id")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    assert len(rows) == len(texts)
    for doc_id, row in rows.iterrows():
        expected = brute(texts[doc_id])
        assert tuple(row[list(quality_rules.COUNTS)]) == expected
        assert row["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
    held = [i for i in marks.index if zlib.crc32(str(i).encode()) % 3 == 1 and not rows.loc[i, "base_failed"]]
    assert (rows.loc[held, "kept"] == (marks[held] == 1)).mean() > 0.97


def test_shapes_and_shares():
    assert [cotraining.shape_of(w) for w in ("Erndly###", "é9,", "ABC!!", "Ä" * 500)] == ["Aa#", "a9,", "A!", "A"]
    features, shares = cotraining.text_features("ab ab cd")
    assert features[-1] == cotraining.DOUBLED and shares[-1] == pytest.approx(1 / 3)
    assert sum(shares[:-1]) == pytest.approx(2)
    assert cotraining.text_features(None) == cotraining.text_features(" ") == ([], [])


def test_pseudo_labels_help_the_other_view():
    """A view that has seen few of its hints learns the others from the other view's confident rows."""
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 6000)
    other = cotraining.Rows.of([[int(v)] for v in y])  # knows the class at once
    own = cotraining.Rows.of([[2 * int(rng.integers(150)) + int(v)] for v in y])  # knows it by one of 150 hints
    labelled = np.arange(160)
    pools = [[r.take(np.arange(1500 * k + 200, 1500 * k + 1700)) for r in (other, own)] for k in range(3)]
    views = [(other.take(labelled), 2), (own.take(labelled), 300)]

    def right(models):
        test = np.arange(5000, 6000)
        margins = own.take(test).margins(models[1].weights) + models[1].bias
        return ((margins > 0) == y[test]).mean()

    alone, helped = cotraining.co_train(views, y[labelled], [], 0.5), cotraining.co_train(views, y[labelled], pools, 0.5)
    assert right(helped) > 0.95 > 0.85 > right(alone)


def test_margins_of_blocks_equal_those_of_features(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["A b b b c### 12", None, "", "one", "x x " * 30]
    model = cotraining.Linear(rng.normal(size=cotraining.TEXT_FEATURES), 0.0)
    trained = cotraining.CoTrained(model, cotraining.Linear(np.zeros(cotraining.PAGE_FEATURES), 0.0), 0.5)
    rows = cotraining.Rows.of(*zip(*[cotraining.text_features(t) for t in texts], strict=True))
    assert trained.text_margins(texts) == pytest.approx(rows.margins(model.weights))
    monkeypatch.setattr(cotraining, "BLOCK_CHARS", 3)
    assert trained.text_margins(texts) == pytest.approx(rows.margins(model.weights))


def test_cotraining_edge_cases(spark):
    rows, marks = learnable(160)
    odd = [(1, None, None, None), (2, "", "en", "a"), (2, "y" * 100_000, "en", "a"), (None, "a b", None, "a")]
    docs = documents(spark, rows + odd)
    model = cotraining.train(docs, labels(spark, [*marks, (None, 1, 1), (1, None, None), (2, 1, 0)]))
    out = cotraining.score(docs, model).collect()
    assert len(out) == len(rows) + 4
    assert all(0 <= r["quality"]["score"] <= 1 and r["score"] == "own" for r in out)
    assert cotraining.score(documents(spark, []), model).count() == 0
    only = cotraining.train(docs, labels(spark, [(1000, 1, 0)]))
    assert all(r["quality"]["kept"] for r in cotraining.score(docs, only).collect())


def test_cotraining_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op1_cotraining(spark, sf_dir).toPandas().set_index("doc_id")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    assert len(rows) == 10_000
    held = [i for i in marks.index if zlib.crc32(str(i).encode()) % 3 == 1]
    assert (rows.loc[held, "kept"] == (marks[held] == 1)).mean() > 0.98
