"""The corpus operators as queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaria.llm import cotraining, pii, quality_rules, toxicity
from vendaria.llm.bpe import encode, load_tokenizer
from vendaria.llm.decontamination import WINDOW, find_passages
from vendaria.llm.decontamination import WORD as BENCHMARK_WORD
from vendaria.llm.labels import held_out
from vendaria.llm.line_dedup import repeated_lines
from vendaria.llm.mixing import mix
from vendaria.llm.ngram_join import ngram_components
from vendaria.llm.periodic import find_runs
from vendaria.llm.topk import top_k
from vendaria.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls
from vendaria.llm.variants import group_variants, word_counts
from vendaria.llm.words import n_words, words_of
from vendaria.sources.scratch import materialize, scratch_dir

URL_RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by both views and combined."""
    docs = _table(spark, sf_dir, "documents")
    model = cotraining.train(docs, _table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select("doc_id", "quality.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes."""
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    sized = materialize(sized, f"{scratch_dir(spark)}/sized")  # the texts are read once
    return mix(sized, F.col("size")).select(
        "doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that repeat an earlier line."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    n_removed = F.size("removed").cast("long").alias("n_removed")
    return repeated_lines(docs).select("doc_id", "n_lines", n_removed, "removed")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    import public_tokenizers  # the other queries do without it

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    bpe = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return encode(docs, bpe, decoded_col="decoded").select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for every page's url."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "url_verdict.*")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under shingle similarity."""
    return ngram_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products for every hundredth embedding."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics, base rules and verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_rules.train(docs, _table(spark, sf_dir, "labels"))
    columns = (*quality_rules.COUNTS, "base_failed", "kept", "score")
    return quality_rules.judge(docs, trees).select("doc_id", *[f"quality.{c}" for c in columns])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of every document's base spans, and all spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_private(docs, pii.train(docs))
    base = F.filter("private", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS
    ]
    digest = F.sha2(pii.as_text(base), 256).alias("base_sha256")
    every = F.size("private").cast("long").alias("n_spans")
    return found.select("doc_id", *counts, digest, pii.as_text(F.col("private")).alias("spans"), every)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by the checksum h of the id, go on in periods from some word on."""

    @F.arrow_udf("string")
    def periodic_text(texts: pa.Array, g: pa.Array) -> pa.Array:
        planted = pc.and_(texts.is_valid(), g.is_valid())
        out = []
        for text, number in zip(texts.filter(planted).to_pylist(), g.filter(planted).to_pylist(), strict=True):
            words = words_of(text)
            if words:
                n = len(words)
                a = number % n
                p = 1 + (n - a) // (3 + number % 8)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            out.append(b" ".join(words).decode())
        return pc.replace_with_mask(texts, planted, pa.array(out, texts.type))

    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # All texts go through it, so that Spark runs it and the search for runs in one Python worker, not in two.
    return docs.withColumn("text", periodic_text(F.col("text"), F.when(h % 10 == 0, F.floor(h / 10))))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, the longest of them, and digests of all runs and of the text without repetitions."""
    docs = _with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = find_runs(docs).select("doc_id", "periodic.*")
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-first["col2"]).alias("start"),
        first["length"].alias("length"),
        (-first["col3"]).alias("period"),
        F.floor(1000 * first["length"] / -first["col3"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, one in 97 with a planted typing error, and the variants among them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_variants(word_counts(docs, typo_every=97))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document passages of the benchmark cover, and the items they are of."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("passages.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "passages.n_words",
        n_hit.alias("n_hit"),
        F.size("passages.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "passages.items"), 256).alias("items_sha256"),
        (F.size("passages.spans") > 0).alias("contaminated"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus that the stages make of the documents."""
    import corpus_pipeline  # it imports this package, so it is not loaded with it

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_cotraining": op1_cotraining,
        "op2_mixing": op2_mixing,
        "op3_line_dedup": op3_line_dedup,
        "op4_bpe": op4_bpe,
        "op5_url_filter": op5_url_filter,
        "op6_ngram_join": op6_ngram_join,
        "op7_topk": op7_topk,
        "op8_quality_rules": op8_quality_rules,
        "op9_pii": op9_pii,
        "op10_toxicity": op10_toxicity,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_decontamination": op13_decontamination,
        "pipeline": pipeline,
    }


_URL_RULES_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)


# Shares `total` among rows by weight, at most twice each row's size: rows reach that in the order of size over weight.
_RESHARED = """
    SELECT * EXCLUDE (level, is_full), CASE WHEN is_full THEN 2.0 * size
           ELSE min(CASE WHEN NOT is_full THEN (ratio, level) END) OVER ({by})[2] * weight END AS target
    FROM (
        SELECT *, 2.0 * size <= level * weight AS is_full
        FROM (
            SELECT *, size / weight AS ratio, (total - coalesce(sum(2.0 * size) OVER (
                       {by} ORDER BY size / weight, {ties} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                   / sum(weight) OVER (
                       {by} ORDER BY size / weight, {ties} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM ({rows})
        )
    )
"""

_SOURCES = _RESHARED.format(
    by="",
    ties="weight, source",
    rows="""SELECT source, size, sum(size) OVER () * 1.5 AS total,
                   [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
            FROM (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source)""",
)
_CLASSES = _RESHARED.format(
    by="PARTITION BY source",
    ties="class",
    rows="""SELECT c.source, c.class, c.size, c.class * c.size AS weight, s.target AS total, s.size AS source_size
            FROM (SELECT source, class, sum(size)::BIGINT AS size FROM sized GROUP BY source, class) c
            JOIN sources s ON s.source IS NOT DISTINCT FROM c.source
            WHERE c.size > 0""",
)

# No bins here: all documents of a source are ranked at once.
_MIX_SQL = f"""
    WITH counted AS (
        SELECT doc_id, source,
               CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
        FROM documents
    ),
    sized AS (
        SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS class,
               (('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, 'null'))[1:12])::BIGINT::DOUBLE + 0.5)
               / 281474976710656.0 AS u
        FROM counted
    ),
    sources AS ({_SOURCES}),
    classes AS ({_CLASSES}),
    plan AS (
        SELECT source, class, floor(target / size) AS whole, target / size - floor(target / size) AS chance,
               total - sum(floor(target / size) * size) OVER (PARTITION BY source) AS lacks
        FROM classes
    ),
    ranked AS (
        SELECT d.*, p.whole, p.lacks, s.size AS source_size, s.target,
               CASE WHEN p.chance > 0 THEN (u / (1 - u)) / (p.chance / (1 - p.chance)) END AS odds
        FROM sized d
        LEFT JOIN plan p ON p.source IS NOT DISTINCT FROM d.source AND p.class = d.class
        LEFT JOIN sources s ON s.source IS NOT DISTINCT FROM d.source
    ),
    placed AS (
        SELECT *, sum(size) OVER (
            PARTITION BY source, odds IS NULL ORDER BY odds, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
        FROM ranked
    )
    SELECT doc_id, size, source_size, target,
           CASE WHEN size > 0
                THEN CAST(size * (whole + CASE WHEN odds IS NOT NULL AND middle <= lacks THEN 1 ELSE 0 END) AS BIGINT)
                ELSE 0 END AS taken
    FROM placed
"""


# Windows and the documents' runs of as many words are joined; the last word of each is found by its place.
_DECONTAMINATION_SQL = f"""
    WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {{words}} AS w FROM documents),
    items AS (SELECT item_id::VARCHAR AS item, {{words}} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT item, w, least(len(w), {WINDOW}) AS n, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i
              FROM items WHERE len(w) > 0)
    ),
    runs AS (
        SELECT d, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT d, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
    ),
    found AS (SELECT d, i, runs.n, item FROM runs JOIN windows USING (phrase)),
    hit AS (SELECT d, count(DISTINCT j) AS n_hit FROM (SELECT d, unnest(range(i, i + n)) AS j FROM found) GROUP BY d),
    named AS (SELECT d, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS names FROM found GROUP BY d)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(len(names), 0)::BIGINT AS n_items,
           sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit USING (d) LEFT JOIN named USING (d)
""".format(
    words="regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    f"'{BENCHMARK_WORD}')"
)


def oracle_sql() -> dict[str, str]:
    return {
        "op13_decontamination": _DECONTAMINATION_SQL,
        "op2_mixing": _MIX_SQL,
        "op7_topk": """
            WITH vectors AS (
                SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
                FROM embeddings
                WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ),
            scored AS (
                SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
                FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
            ),
            ranked AS (
                SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
                FROM scored
            )
            SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
        """,
        "op5_url_filter": f"""
            WITH rules(verdict, host, path) AS (VALUES {_URL_RULES_SQL}),
            cut AS (
                SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN
                    regexp_replace(substr(url, position('://' IN url) + 3), '[?#].*$', '', 's') ELSE '' END AS rest
                FROM pages
            ),
            split AS (
                SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/]*') AS raw,
                       substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/]*')) + 1) AS path
                FROM cut
            ),
            urls AS (
                SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
                FROM split
            ),
            fits AS (
                SELECT u.page_id, r.host || r.path AS rule, r.verdict
                FROM urls u JOIN rules r
                  ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
            ),
            longest AS (SELECT page_id, arg_max((rule, verdict), length(rule)) AS best FROM fits GROUP BY page_id)
            SELECT u.page_id, u.host, u.path, best[1] AS rule, coalesce(best[2], 'allow') AS verdict
            FROM urls u LEFT JOIN longest l ON u.page_id = l.page_id
        """,
    }
