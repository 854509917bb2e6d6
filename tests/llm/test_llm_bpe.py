import hashlib

import public_tokenizers
import pytest
from edge_cases import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vendaria.llm import registry
from vendaria.llm.bpe import decode, encode, load_tokenizer
from vendaria.llm.memo import Memo

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
BPE = load_tokenizer(PATH)
ENCODE = BPE.encoder(memo_size=50)

SOME = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeiou tsr'\n\t.,19É\x1c\u0301\u00a0")), max_size=60)
# Some letters, numbers and marks that are newer than Unicode 15: they compose, have a lower case, or are unknown still.
NEWER = st.text(st.sampled_from("\U000105d2\u0307\U00016d67\U00016d63\U0001611e\U00011382\U000113c9\ua7cb\u1c89\U00010d50\U00010d40\U0003d000ae\u0301!1 "), max_size=20)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(SOME, NEWER))
def test_same_ids_as_the_library(text):
    ids = ENCODE(text)
    assert ids == library_ids(text)
    assert BPE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "I'm he'll WE'VE x's don't",
        "<|startoftext|>a<|endoftext|><|endoftext|",
        "ΣΑΣ İ Straße ﬁ ẞ",
        "a" * 5000,
        "e\u0301 \u1100\u1161 가",
        "1234567890 3.14",
        "\x1c\x1d\x1e\x1f",
    ],
)
def test_known_hard_texts(text):
    assert ENCODE(text) == library_ids(text)


def test_every_code_point():
    """In a word, between signs, after a number and among marks that compose; planes without characters are left out."""
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE0200))
    for i in range(0, len(points), 4096):
        text = " ".join(f"a{c}b !{c}! 1{c} e\u0301{c}\u0301 q\u0301{c} e{c}\u0327" for c in map(chr, points[i : i + 4096]))
        assert ENCODE(text) == library_ids(text), hex(points[i])


def test_memo_of_any_size_gives_the_same():
    text = prose(300)
    assert BPE.encoder(1)(text) == BPE.encoder(10_000)(text) == library_ids(text)
    memo = Memo(len, 3)
    assert [memo["x" * (k % 7)] for k in range(50)] == [k % 7 for k in range(50)]
    assert len(memo) <= 3


def test_edge_cases(spark):
    docs = documents(spark)
    bpe = load_tokenizer(PATH)
    rows = decode(encode(docs, bpe, decoded_col="decoded"), bpe, text_col="again").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["token_ids"] == library_ids(row["text"] or "")
        assert row["decoded"] == row["again"] == LIBRARY.decode(row["token_ids"], skip_special_tokens=False)
        assert row["size"] == row["0 odd.name"] == "own"
    assert encode(documents(spark, []), bpe).count() == 0
    assert encode(docs, bpe, ids_col="score").schema["score"].dataType.typeName() == "array"


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.op4_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library_ids(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
