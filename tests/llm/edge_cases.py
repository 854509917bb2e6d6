"""Documents that every operator has to take: nulls, blanks, long texts, repeats, columns of odd names."""

from pyspark.sql import types as T

# Names that operators use inside, or might.
_OWN = "own_key id key removed label toxicity mix copy first url_verdict".split()
ODD_NAMES = ["size", "score", "a", "set", "text_key", "row", "copies", "0 odd.name", "word", "n"]
ODD_NAMES += [prefix + name for name in _OWN for prefix in ("_", "__")]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ODD_NAMES],
    ]
)

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly make toxic jars of grey paint".split()


def prose(n: int, start: int = 0) -> str:
    return " ".join(f"{WORDS[(i * 7 + start * 3 + i // 11) % len(WORDS)]}{(i * i + start) % 13}" for i in range(n))


def documents(spark, rows=None):
    """(doc_id, text, lang, source) rows, by default one of each kind."""
    if rows is None:
        rows = [
            (1, prose(40), "en", "web"),
            (2, prose(40), "en", "web"),  # an exact copy
            (3, None, None, None),
            (4, "", "en", "web"),
            (5, " \t\n\x0b\x0c\r ", "de", "news"),
            (6, "word", "en", None),
            (7, "word", None, "web"),
            (8, "x" * 200_000, "en", "web"),
            (9, " ".join([prose(500, k) for k in range(60)]), "en", "news"),
            (None, prose(25, 5), "en", "web"),
            (10, prose(30, 9), "en", "web"),
            (10, prose(30, 9), "en", "web"),  # a repeated row
            (11, "é ß 漢字 \U0001f600 a\u00a0b\x1cc", "fr", "été"),
        ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["own"] * len(ODD_NAMES)) for r in rows], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def learnable(n: int = 60) -> tuple[list[tuple], list[tuple]]:
    """Documents and labels: every third insults, every fourth is noise."""
    docs, marks = [], []
    for i in range(n):
        text = prose(60, i)
        if i % 3 == 0:
            text += f" you stupid idiot number{i} worthless moron"
        if i % 4 == 0:
            text = " ".join(f"{w}### |" for w in text.split())
        docs.append((1000 + i, text, "en", f"src{i % 3}"))
        marks.append((1000 + i, int(i % 4 != 0), int(i % 3 == 0)))
    return docs, marks
