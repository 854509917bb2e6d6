import hashlib
import math
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from edge_cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from vendaria.llm import pii
from vendaria.llm.registry import op9_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TEXT = st.text(st.sampled_from("a1.2@-+ (9)b%5\né"), max_size=60)
NUMBERS = st.text(st.sampled_from("0123456789 -+(."), max_size=80)
CARD_NUMBER = "4041894974608795"


def brute(text):
    """The patterns as they are written, then the checks."""
    out = []
    for kind, pattern in zip(pii.KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and doubled % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end(), True))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.one_of(TEXT, NUMBERS, st.lists(st.sampled_from([CARD_NUMBER, "1.2.3.4", "+1 (234) 555-6789", "a.b@c.de", " ", "-", "x"])).map("".join)))
def test_base_equals_the_patterns(text):
    assert [tuple(s) for s in pii.base_spans(text)] == brute(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "@" * 200_000, "+1 " + "2 " * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(1)
    texts = []
    for k in range(200):
        d = "".join(map(str, rng.integers(0, 10, 30)))
        kinds = [f"bob{d[:2]}@mail{d[2]}.example.com", f"{int(d[:2])}.{int(d[3:5])}.{int(d[5:7])}.{int(d[7:9])}",
                 f"+1 ({d[10:13]}) 555-{d[13:17]}", f"version {d[20]}.0", f"in {d[21:25]} and", CARD_NUMBER]
        texts.append(" words between ".join(rng.permutation(kinds)))
    return pii.fit(texts)


def test_field_adds_what_the_patterns_miss(field):
    text = f"call +1 (269) 555-3296 {CARD_NUMBER} now"
    assert pii.base_spans(text) == []
    spans = field.spans([text], [[]])[0]
    assert [(s.kind, text[s.start : s.end], s.base) for s in spans] == [
        ("card", CARD_NUMBER, False), ("phone", "+1 (269) 555-3296", False)
    ]


def test_field_leaves_clean_text_and_base_spans_alone(field):
    text = "version 3.0 of 2024, see 1.2.3.4 or a.b@c.de"
    base = pii.base_spans(text)
    assert field.spans([text, "", "no digits"], [base, [], []]) == [base, [], []]


def test_skip_edges_make_a_document_agree():
    """Of two like words far apart, the one with no context takes the other's label."""
    unary = np.zeros((pii.FEATURES, len(pii.LABELS)))
    unary[pii._feature("before=card"), 3] = 6.0
    unary[pii._feature("bias"), 0] = 1.0
    text = "card 12345 and later on, somewhere else, 12345 again and 67890"
    graph = pii.graph_of([text])
    assert graph.skip.tolist() == [[0, 1]] and len(graph.chain) == 0
    flat = np.zeros((5, 5))
    alone = pii.Field(unary, flat, flat).beliefs(graph)[0].argmax(axis=1)
    joined = pii.Field(unary, flat, 4 * np.eye(5)).beliefs(graph)[0].argmax(axis=1)
    assert alone.tolist() == [3, 0, 0] and joined.tolist() == [3, 3, 0]


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    text = "a1 b2 c3 x a1"  # a chain of three and a skip edge: no loop
    graph = pii.graph_of([text])
    field = pii.Field(rng.normal(size=(pii.FEATURES, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    unary = np.zeros((4, 5))
    np.add.at(unary, graph.owner, field.unary[graph.feature])
    joint = np.zeros((5,) * 4)
    for index in np.ndindex(*joint.shape):
        joint[index] = sum(unary[i, x] for i, x in enumerate(index))
        joint[index] += sum(field.chain[index[a], index[b]] for a, b in graph.chain)
        joint[index] += sum(field.skip[index[a], index[b]] for a, b in graph.skip)
    joint = np.exp(joint - joint.max())
    joint /= joint.sum()
    pii_beliefs, _ = field.beliefs(graph)
    for i in range(4):
        exact = joint.sum(axis=tuple(k for k in range(4) if k != i))
        assert pii_beliefs[i] == pytest.approx(exact, abs=0.02)


def plain_labels(text, field):
    """Words of one text with their likeliest label and its belief, one word, edge and label at a time."""
    nodes, chain, skip, previous = [], [], set(), None
    for m in re.finditer(r"\S+", text):
        core = re.search(r"[+(]*[0-9A-Za-z](?:.*[0-9A-Za-z])?\)?", m.group())
        if core is None or not re.search("[0-9@]", core.group()):
            previous = m.group().lower()
            continue
        word, here = core.group(), len(nodes)
        coarse = re.sub("[0-9]+", "d", re.sub(r"[^\W\d_]+", "a", word))
        digits = re.sub("[^0-9]", "", word)
        names = pii._word_features(word, pii._form(word), digits)
        if isinstance(previous, int):
            names.append(f"before={nodes[previous][4]}")
            nodes[previous][3].append(f"after={coarse}")
            chain.append((previous, here))
        else:
            names.append(f"before={previous or ''}")
        for other in range(here - 1, -1, -1):  # the last earlier one only
            if nodes[other][2].lower() == word.lower():
                skip.add((other, here))
                break
        for other in range(here - 1, -1, -1):
            if len(digits) >= 4 and nodes[other][5] == digits:
                skip.add((other, here))
                break
        nodes.append([m.start() + core.start(), m.start() + core.end(), word, names, coarse, digits])
        previous = here
    labels = range(len(pii.LABELS))
    own = [[sum(field.unary[pii._feature(n)][x] for n in node[3]) for x in labels] for node in nodes]
    edges = [(a, b, field.chain) for a, b in chain] + [(a, b, field.skip) for a, b in sorted(skip)]
    messages = {(k, to): [0.0] * len(labels) for k, edge in enumerate(edges) for to in edge[:2]}

    def total(i, x):
        return own[i][x] + sum(messages[k, i][x] for k, edge in enumerate(edges) if i in edge[:2])

    for _ in range(pii.ITERATIONS):
        sums = [[total(i, x) for x in labels] for i in range(len(nodes))]
        new = {}
        for k, (a, b, potential) in enumerate(edges):
            for sender, to in ((a, b), (b, a)):
                out = []
                for y in labels:
                    between = [potential[x][y] if sender == a else potential[y][x] for x in labels]
                    out.append(math.log(sum(math.exp(sums[sender][x] - messages[k, sender][x] + between[x]) for x in labels)))
                new[k, to] = [0.5 * m + 0.5 * (o - max(out)) for m, o in zip(messages[k, to], out)]
        messages = new
    result = []
    for i, node in enumerate(nodes):
        weights = [math.exp(total(i, x) - max(total(i, y) for y in labels)) for x in labels]
        best = max(labels, key=weights.__getitem__)
        result.append((node[0], node[1], best, weights[best] / sum(weights)))
    return result, set(chain)


def plain_added(text, field):
    """Spans that the field adds: confident words, rows of a card's or a phone's, that no base span touches."""
    found, chain = plain_labels(text, field)
    kinds = [pii.LABELS[best] if belief >= pii.CONFIDENT else "" for _, _, best, belief in found]
    out, i = [], 0
    while i < len(found):
        first, i = i, i + 1
        while kinds[first] in ("card", "phone") and i < len(found) and (i - 1, i) in chain and kinds[i] == kinds[first]:
            n = len(re.sub("[^0-9]", "", text[found[first][0] : found[i][1]]))
            if text[found[i][0]] == "+" or n > {"card": 19, "phone": 15}[kinds[first]]:
                break
            i += 1
        a, b, kind = found[first][0], found[i - 1][1], kinds[first]
        n = len(re.sub("[^0-9]", "", text[a:b]))
        fits = {
            "": False,
            "email": "@" in text[a:b] and "." in text[a:b],
            "ip": text[a:b].count(".") == 3 and 4 <= n <= 12,
            "card": 16 <= n <= 19,
            "phone": 8 <= n <= 15,
        }[kind]
        if fits and not any(s < b and a < e for _, s, e, _ in brute(text)):
            out.append((kind, a, b, False))
    return out


PIECES = [CARD_NUMBER, "4041 8949 7460 8795", "+1 (269) 555-3296", "+1 (269) 555-3296 4041894974608795", "1.2.3.4", "1.2.3.4.5",
          "a.b@c.de", "bob12@mail1.example.com,", "version 3.0", "(2024)", "called", "555-3296", "12345", "x@y", "((9é"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=9).map(" ".join))
def test_spans_equal_a_plain_field(field, text):
    expected = sorted(brute(text) + plain_added(text, field), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert [tuple(s) for s in field.spans([text], [pii.base_spans(text)])[0]] == expected


def test_plain_field_adds_spans(field):
    """The comparison is not one of empty lists."""
    assert plain_added(f"call +1 (269) 555-3296 {CARD_NUMBER} now", field)


def test_words_count_whole():
    """Words that differ only far from their start are not joined; those of the same digits are."""
    long = "1" * 200
    assert pii.graph_of([f"{long}7 x {long}8"]).skip.tolist() == []
    assert pii.graph_of([f"{long}7 x a{long}7 x {long}7"]).skip.tolist() == [[0, 1], [0, 2], [1, 2]]
    one, two = (pii.graph_of([f"{'c' * 60}{k} 5"]).feature.tolist() for k in "xy")
    assert one != two


def test_memory_follows_the_words_of_a_block(field):
    text = " ".join(str(k * 7919 % 1_000_003) for k in range(30_000))
    tracemalloc.start()
    field.spans([text], [[]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000 * 700 + 60 * pii.EDGES * 25  # bytes of a word, and some copies of one piece of edges


def test_blocks_hold_all_texts():
    texts = pd.Series(["a" * 40, None, "", "b" * 70, "c" * 500, "d" * 10, "e" * 90, "f"])
    blocks = list(pii._blocks(texts, 100))
    assert blocks == [[0], [3], [4], [5, 6], [7]]
    assert list(pii._blocks(texts[:0])) == []


def test_many_spans_in_one_text(field):
    text = "call +1 (269) 555-3296 4041894974608795 a.b@c.de now " * 4000
    spans = field.spans([text], [pii.base_spans(text)])[0]
    assert sum(s.base for s in spans) == 4000 and sum(not s.base for s in spans) == 8000


def test_edge_cases(spark, field):
    rows = [(1, "a.b@c.de 1.2.3.4", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (None, "é +12345678", "en", "s"),
            (4, "9" * 100_000, "en", "s"), (5, "x " * 50_000 + "a.b@c.de", "en", "s"), (5, "none", "en", "s")]
    docs = documents(spark, rows)
    found = {(r["doc_id"], r["text"]): [tuple(s) for s in r["set"]] for r in pii.find_private(docs, field, output="set").collect()}
    for doc_id, text, *_ in rows:
        assert [s for s in found[doc_id, text] if s[3]] == brute(text or "")
    assert pii.find_private(documents(spark, []), field).count() == 0
    assert pii.train(documents(spark, [])).spans(["a 1"], [[]]) == [[]]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op9_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = [f"{k}:{a}:{b}" for k, a, b, _ in brute(texts[row["doc_id"]])]
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        every = [s for s in row["spans"].split(",") if s]
        assert set(base) <= set(every)
        assert every == sorted(every, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
