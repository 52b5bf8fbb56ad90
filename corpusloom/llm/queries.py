"""One query for each operator over its whole table, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import decontaminate, exact_dedup, hmm, mixing, near_dedup, neighbours, prefix_trie, quality, secrets, sharding, token_files, url_filter, vector_codes

TOKENIZER = "byte_bpe_50k.json"
TREE = sharding.HashTree.even(regions=2, racks=3, shards=4)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of documents that make all sources weigh the same at today's volume."""
    mixed = mixing.poisson_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("_copy").cast("int").alias("copy"), F.col("_order").alias("order_key"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), TREE)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the best grade of every document, and whether it is selected."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_ordinal(docs, quality.graded_labels(table(spark, sf_dir, "labels")))
    graded = quality.grades(docs, model)
    return graded.withColumn("selected", F.col("p_best") >= quality.KEEP_AT)


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return hmm.score_texts(table(spark, sf_dir, "documents"), held_out)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=2, share=80)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "tokens")
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return token_files.read_tokens(files)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_neighbours": op2_neighbours,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality,
    "op7_hmm": op7_hmm,
    "op8_near_dedup": op8_near_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_files": op10_token_files,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_exact_dedup": op13_exact_dedup,
}

_TERMS_STRICT = ", ".join(f"'{t}'" for t in url_filter.STRICT)
_TERMS_SOFT = ", ".join(f"'{t}'" for t in url_filter.SOFT)
_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _hits(terms: str) -> str:
    return f"len(list_filter([{terms}], lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')))"


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT row, {number} AS number, '{kind}' AS kind,
           CAST(list_sum(list_transform(pieces[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
           length(found[i]) AS len, length(vals[i]) AS size
    FROM (SELECT row, pieces, found, vals, unnest(generate_series(1, len(found))) AS i FROM (
        SELECT row, string_split_regex(t, '{quoted}') AS pieces, regexp_extract_all(t, '{quoted}', 0) AS found,
               regexp_extract_all(t, '{quoted}', {group}) AS vals FROM rows WHERE regexp_matches(t, '{quoted}')))
    WHERE length(vals[i]) >= {least}"""


_KINDS = [
    (0, "assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    (1, "access", r"AKIA[A-Z0-9]+", 0, 20),
    (2, "hex", r"[0-9a-f]+", 0, 24),
    (3, "github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    (4, "pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
]

def _vector_round(r: int) -> str:
    """Assignment of all parts to codebook ``r``, and codebook ``r + 1``."""
    return f"""
        near{r} AS MATERIALIZED (
            SELECT row, p, min({{'d': list_sum(list_transform(list_zip(parts.x, books{r}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
            FROM parts JOIN books{r} USING (p) GROUP BY row, p),
        sums{r} AS (
            SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS c
            FROM parts JOIN near{r} USING (row, p), LATERAL (SELECT unnest(generate_series(1, len(x))) AS i) GROUP BY 1, 2, 3),
        means{r} AS (SELECT p, e, list((((s - ((s % c) + c) % c) // c))::BIGINT ORDER BY i) AS x FROM sums{r} GROUP BY p, e),
        books{r + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(m.x, b.x) AS x FROM books{r} b LEFT JOIN means{r} m USING (p, e))"""


ORACLE: dict[str, str] = {
    "op1_mixing": """
        WITH RECURSIVE volumes AS (
            SELECT source, coalesce(sum(strlen(text)), 0)::BIGINT AS volume FROM documents GROUP BY source),
        rates AS (
            SELECT source, CASE WHEN volume > 0
                   THEN (SELECT sum(volume) FROM volumes)::DOUBLE * 1.0 / (SELECT count(*) FROM volumes WHERE volume > 0) / volume ELSE 0 END AS rate
            FROM volumes),
        terms AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
            UNION ALL
            SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM terms
            WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
        draws AS (
            SELECT doc_id, source, ('0x' || substr(md5('mix-1:' || doc_id || ':1'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
            FROM documents),
        counted AS (
            SELECT d.doc_id, d.source, count(*) AS n FROM draws d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.c <= d.u GROUP BY 1, 2)
        SELECT doc_id, source, copy::INTEGER AS copy, md5('mix-1:order:' || doc_id || ':' || copy) AS order_key
        FROM (SELECT doc_id, source, unnest(generate_series(1, n)) AS copy FROM counted)""",
    "op4_secrets": f"""
        WITH rows AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({" UNION ALL ".join(_spans(*k) for k in _KINDS)}),
        joined AS (
            SELECT row, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex,
                   string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, number) FILTER (number <= 2) AS base,
                   string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, number) AS spans
            FROM spans GROUP BY row)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM rows LEFT JOIN joined USING (row)""",
    "op5_url_filter": f"""
        WITH parts AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_A_TO_Z}) AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, translate(coalesce(url, ''), {_A_TO_Z}) AS low FROM pages),
        judged AS (
            SELECT *, CASE
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
                {_hits(_TERMS_STRICT)}::INTEGER AS n_strict, {_hits(_TERMS_SOFT)}::INTEGER AS n_soft
            FROM parts)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
               WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft
        FROM judged""",
    "op11_prefix_trie": """
        WITH own AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                   {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM own)),
        built AS (
            SELECT c.conv_id, pos, turn FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND pos <= h
            UNION ALL
            SELECT conv_id, pos + 9, turn FROM convs JOIN own USING (conv_id) WHERE pos > h),
        paths AS (
            SELECT conv_id, coalesce(path, []) AS path
            FROM convs LEFT JOIN (SELECT conv_id, list(turn ORDER BY pos) AS path FROM built GROUP BY 1) USING (conv_id)),
        nodes AS MATERIALIZED (
            SELECT path[:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(path) = d) AS ends
            FROM (SELECT *, unnest(generate_series(0, len(path))) AS d FROM paths) GROUP BY 1, 2),
        kids AS (SELECT p[:d - 1] AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1),
        sums AS (
            SELECT p[:j] AS p, sum(leaf) AS leaves, sum(saved) AS saved
            FROM (SELECT p, unnest(generate_series(0, d)) AS j, (kids IS NULL)::BIGINT AS leaf, CASE WHEN d > 0 THEN (n - 1) * strlen(p[d].text) ELSE 0 END AS saved
                  FROM nodes LEFT JOIN kids USING (p)) GROUP BY 1)
        SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n AS n_convs, coalesce(kids, 0) AS n_children, leaves::BIGINT AS n_leaves,
               saved::BIGINT AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
        FROM nodes a JOIN sums USING (p) LEFT JOIN kids USING (p) LEFT JOIN nodes b ON a.d > 0 AND b.p = a.p[:a.d - 1]""",
    "op12_vector_codes": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
                   list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT row, p, v[p * (len(v) // {vector_codes.PARTS}) + 1:(p + 1) * (len(v) // {vector_codes.PARTS})] AS x
            FROM kept, range({vector_codes.PARTS}) t(p)),
        books0 AS MATERIALIZED (SELECT p, row - 1 AS e, x FROM parts WHERE row <= {vector_codes.ENTRIES}),
        {",".join(_vector_round(r) for r in range(vector_codes.ROUNDS + 1))},
        coded AS (
            SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{vector_codes.ROUNDS} GROUP BY row)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM books{vector_codes.ROUNDS}) AS codebooks_sha256
        FROM coded JOIN kept USING (row)""",
    "op13_exact_dedup": """
        WITH bodies AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
        FROM bodies""",
}
