import pandas as pd
import pytest
from edge_cases import documents, prose
from pyspark.sql import functions as F

from vendaria.llm.mixing import mix, mixed, random_of
from vendaria.llm.registry import op2_mixing
from vendaria.llm.words import n_words


def targets(sizes, weights, share, cap):
    """Reshare the excess until none is above its cap."""
    total, fixed = share * sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        level = {i: rest * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if level[i] > cap * sizes[i]]
        if not over:
            return [fixed.get(i, level.get(i)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


def corpus(spark, shape):
    rows = []
    for source, docs in shape.items():
        rows += [(len(rows) + k, prose(n, k), "en", source) for k, n in enumerate(docs)]
    return documents(spark, rows)


SHAPE = {"a": [20] * 50, "b": [5, 300] * 60, "é": [7] * 400, None: list(range(1, 120)), "tiny": [3]}


def test_targets_and_sizes(spark):
    docs = corpus(spark, SHAPE)
    out = mix(docs).select("doc_id", "source", "mix.*").toPandas()
    order = sorted((s for s in SHAPE if s is not None)) + [None]
    sizes = [sum(SHAPE[s]) for s in order]
    expected = dict(zip(order, targets(sizes, [3, 1, 2, 3, 1], 1.5, 2.0), strict=True))
    out["taken"] = out["size"] * out["copies"]
    for source, rows in out.groupby(out["source"].fillna("null")):
        name = None if source == "null" else source
        assert rows["target"].iloc[0] == pytest.approx(expected[name])
        assert rows["source_size"].eq(sum(SHAPE[name])).all()
        assert abs(rows["taken"].sum() - expected[name]) <= max(SHAPE[name]) / 2 + 1e-6
    assert out["copies"].between(0, 2).all()
    assert out["target"].groupby(out["source"].fillna("null")).first().sum() == pytest.approx(1.5 * sum(sizes))
    again = mix(docs.repartition(7)).select("doc_id", "source", "mix.*").toPandas()
    key = ["doc_id", "source"]
    pd.testing.assert_frame_equal(
        out.drop(columns="taken").sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True)
    )


def test_inclusion_is_near_its_chance(spark):
    """Over many seeds a document is taken as often as its class's ratio says."""
    rows = [(k, prose(10 if k % 2 else 40, k), "en", "s" if k < 40 else "t") for k in range(80)]
    docs = documents(spark, rows).select("doc_id", "source", n_words(F.col("text")).alias("size")).cache()
    taken = [
        mix(docs, F.col("size"), share=0.7, seed=f"{k}").select("doc_id", "source", "mix.*").toPandas() for k in range(12)
    ]
    both = pd.concat(taken)
    mean = both.groupby(["source", "size"])["copies"].mean()
    short_s, long_s = mean["s", 10], mean["s", 40]
    assert long_s > short_s  # unequal probabilities: more binary digits, more copies
    for source in ("s", "t"):
        words = both[both["source"] == source]
        per_run = (words["size"] * words["copies"]).sum() / 12
        assert per_run == pytest.approx(words["target"].iloc[0], abs=20)


def test_edge_cases(spark):
    docs = documents(spark)
    out = mix(docs)
    assert out.columns == [*docs.columns, "mix"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["mix"]["size"] == len((row["text"] or "").encode().split())
        assert row["mix"]["copies"] <= (2 if row["mix"]["size"] else 0)
        assert row["row"] == row["size"] == "own"
    again = mixed(docs)
    assert again.columns == docs.columns
    assert again.count() == sum(r["mix"]["copies"] for r in rows)
    assert mix(documents(spark, [])).count() == 0
    assert [r["mix"]["copies"] for r in mix(documents(spark, [(1, None, "en", "a"), (2, "", "en", "a")])).collect()] == [0, 0]
    with pytest.raises(ValueError, match="cap"):
        mix(docs, share=3.0)


def test_random_numbers_are_inside_and_spread(spark):
    u = spark.range(4000).select(random_of(F.col("id"), "s").alias("u")).toPandas()["u"]
    assert 0 < u.min() < 0.01 and 0.99 < u.max() < 1 and abs(u.mean() - 0.5) < 0.03


def test_query(spark):
    out = op2_mixing(spark, "/root/testdata/sf0.01").toPandas()
    assert len(out) == 1000
    sums = out.assign(source_size=out["source_size"], target=out["target"]).groupby("source_size")
    for _, rows in sums:
        assert abs(rows["taken"].sum() - rows["target"].iloc[0]) <= rows["size"].max() / 2 + 1e-6
    assert (out["taken"] <= 2 * out["size"]).all()
