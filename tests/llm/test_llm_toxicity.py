import zlib

import numpy as np
import pytest
from edge_cases import documents, labels, learnable, prose
from pyspark.sql import functions as F

from vendaria.llm import toxicity
from vendaria.llm.labels import held_out
from vendaria.llm.registry import op10_toxicity


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    insults = ["idiot", "moron", "worthless", "stupid"]
    texts = [prose(80, i) for i in range(120)]
    marks = np.arange(120) % 2
    for i in np.flatnonzero(marks):
        words = texts[i].split()
        for word in rng.choice(insults, 3):
            words.insert(int(rng.integers(len(words))), word)
        texts[i] = " ".join(words)
    return toxicity.fit(texts, marks)


def test_held_out_texts_and_misspellings(model):
    clean = model.scores([prose(90, k) for k in range(200, 240)])
    insulting = model.scores([f"{prose(60, k)} what a worthless idiot {prose(60, k + 1)}" for k in range(200, 240)])
    assert (clean < 0.7).mean() > 0.95
    assert (insulting >= 0.7).mean() > 0.9
    assert model.scores(["you idiiot and moronic worthles fool"])[0] > 0.7  # none of these words was seen


def test_whole_text_and_blocks_count(model, monkeypatch):
    long = " ".join(prose(400, k) for k in range(30))
    texts = [long + " stupid idiot moron", long, None, "", " \n ", "idiot " * 500]
    together = model.scores(texts)
    assert together[0] > 0.7 > together[1]
    assert list(together[2:5]) == [0, 0, 0]
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 10)
    assert model.scores(texts) == pytest.approx(together)


def test_gradient_reaches_both_layers():
    one = toxicity.fit(["bad bad word here"] * 3 + ["good word there"] * 3, np.array([1, 1, 1, 0, 0, 0]))
    assert one.scores(["bad word"])[0] > one.scores(["good word"])[0]


def test_one_label_or_none():
    assert toxicity.fit(["a b"], np.array([1])).scores(["x", "a", ""]).round(3).tolist() == [1, 1, 0]
    assert toxicity.fit([], np.array([], int)).scores(["x", None]).round(3).tolist() == [0, 0]


def test_edge_cases(spark):
    rows, marks = learnable()
    docs = documents(spark, rows + [(1, None, None, None), (2, "", "en", "a"), (2, "x" * 100_000, "en", "a"), (None, "idiot", "en", "a")])
    model = toxicity.train(docs, labels(spark, [*marks, (None, 1, 1), (1, None, None), (2, 0, 0), (99999, 1, 1)]))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + 4
    assert all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.score(documents(spark, []), model).count() == 0
    assert toxicity.train(documents(spark, []), labels(spark)).scores(["idiot"])[0] < 0.5


def test_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = op10_toxicity(spark, sf_dir)
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(marks, "doc_id").filter("held_out").toPandas()
    assert found.count() == 10_000
    assert rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1).all()
    # A fifth of these labels is at random: insulting words are in about four of five texts that are marked.
    assert rows[rows["predicted"] == 1]["toxic"].mean() > 0.9
    assert rows[rows["toxic"] == 1]["predicted"].mean() > 0.55
    assert (rows["predicted"] == (rows["score"] >= 0.7)).all()


def test_held_out_ids(spark):
    ids = [0, 1, 5, 77, 123456, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("h"))
    assert [r["h"] for r in rows.collect()] == [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids]
