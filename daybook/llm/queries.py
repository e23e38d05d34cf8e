"""The operators as queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.collocations import mine_collocations
from daybook.llm.conversations import damage, repair
from daybook.llm.conversations_sql import REPAIR_SQL
from daybook.llm.decontaminate import find_contamination
from daybook.llm.digests import base_digest, count_of, listed, scored
from daybook.llm.grading import grade, grades_of
from daybook.llm.lattice import read_vocabulary, score_documents
from daybook.llm.mixing import mix
from daybook.llm.pii import BASE_KINDS as PII_KINDS
from daybook.llm.pii import find_pii
from daybook.llm.secrets import BASE_KINDS as SECRET_KINDS
from daybook.llm.secrets import EXAMPLE, LIVE, find_secrets
from daybook.llm.sharding import shard
from daybook.llm.simhash import as_hex, find_near_duplicates
from daybook.llm.stream_dedup import deduplicate
from daybook.llm.token_files import tokenize
from daybook.llm.url_filter import ALLOW, BLOCK, Rule, filter_urls
from daybook.llm.url_filter_sql import filter_urls_sql

SHARDS = 40
URL_RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    return score_documents(table(spark, sf_dir, "documents"), pieces)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = shard(table(spark, sf_dir, "documents"), SHARDS)
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op4_grading(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    ratings = grades_of(labels, F.col("quality"), F.col("toxic"))
    return grade(table(spark, sf_dir, "documents"), ratings)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("pii")
    return found.select(
        "doc_id",
        *(count_of(spans, kind).alias(f"n_{kind}") for kind in PII_KINDS),
        base_digest(spans).alias("base_sha256"),
        listed(spans).alias("spans"),
        scored(spans).alias("scores"),
    )


def op6_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("secrets")
    with_verdict = lambda v: F.size(F.filter(spans, lambda s: s["verdict"] == v)).cast("long")
    return found.select(
        "doc_id",
        *(count_of(spans, kind).alias(f"n_{kind}") for kind in SECRET_KINDS),
        base_digest(spans).alias("base_sha256"),
        listed(spans).alias("spans"),
        with_verdict(LIVE).alias("n_live"),
        with_verdict(EXAMPLE).alias("n_example"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"), least=10, longest=3, share=50, top=2000)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "branch")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = damage(table(spark, sf_dir, "conversations"))
    return repair(damaged, present=F.col("present"))


QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_sharding": op2_sharding,
    "op3_token_files": op3_token_files,
    "op4_grading": op4_grading,
    "op5_pii": op5_pii,
    "op6_stream_dedup": op6_stream_dedup,
    "op7_simhash": op7_simhash,
    "op8_decontaminate": op8_decontaminate,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_collocations": op11_collocations,
    "op12_url_filter": op12_url_filter,
    "op13_conversation_repair": op13_conversation_repair,
}

# White space and separators as the contracts name them, for the SQL engine.
_SQL_SPACE = "[\\x20\\x09-\\x0D]+"
_SQL_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {
    "op6_stream_dedup": f"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SQL_SPACE}', ' ', 'g') AS t FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op8_decontaminate": f"""
        WITH dw AS (
            SELECT doc_id, list_filter(
                string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_SQL_SEPARATORS}'),
                lambda w: w <> '') AS w
            FROM documents
        ), bw AS (
            SELECT item_id, list_filter(
                string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_SQL_SEPARATORS}'),
                lambda w: w <> '') AS w
            FROM benchmark
        ), wins AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS m,
                   array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)
        ), places AS (
            SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
            FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM dw, (SELECT DISTINCT m FROM wins) WHERE len(w) >= m)
        ), hits AS (SELECT doc_id, i, places.m, item_id FROM places JOIN wins USING (win, m)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id
        ), hit_items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM hits GROUP BY doc_id
        )
        SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(hit_words.n, 0) AS n_hit,
               coalesce(hit_items.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(hit_words.n, 0) > 0 AS contaminated
        FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op11_collocations": f"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, p
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                      translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS p
                  FROM documents)
        ), words AS (
            SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), counts AS MATERIALIZED (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM words, (VALUES (1), (2), (3)) sizes(m) WHERE len(w) >= m)
            GROUP BY ALL
        ), cuts AS (
            SELECT lang, m, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM counts WHERE m > 1 AND f >= 10)
        ), scored AS (
            SELECT c.lang, c.m, c.phrase, a, x.f AS l, y.f AS r,
                   (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = first
            JOIN counts y ON y.lang = c.lang AND y.phrase = rest
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
        ), longer AS (
            SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(f) AS most
            FROM (SELECT lang, string_split(phrase, ' ') AS w, f, unnest([1, 2]) AS i FROM counts WHERE m = 3 AND f >= 10)
            GROUP BY ALL
        ), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM scored JOIN totals USING (lang) LEFT JOIN longer USING (lang, phrase)
        WHERE NOT coalesce(m = 2 AND 100 * most >= 50 * a, false)
        QUALIFY rank <= 2000
    """,
    "op12_url_filter": filter_urls_sql(URL_RULES),
    "op13_conversation_repair": REPAIR_SQL,
}
