"""The numbered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroid_clusters import clustered
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .language_id import identify_languages
from .lm_scores import score_documents
from .mixing import mixed
from .ngram_join import near_duplicates
from .pieces import piece_digests
from .sharding import shard_documents
from .storage import new_folder, stored
from .substring_dedup import remove_repeats
from .token_counts import token_counts
from .warc import captures, read_records, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A public tokenizer's file; it is read where it is installed, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE["op2_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n_cp DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM g
"""


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return captures(stored(read_records(spark, path, payload=False), "records"))


ORACLE["op4_warc"] = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS original,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::INTEGER >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31) + 1, 1)),
           'string_agg', '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM d
"""


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), limit=2048)


@query
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents")).drop("rejected")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits")


ORACLE["op6_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS phrase
  FROM b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS phrase
  FROM d, (SELECT DISTINCT n FROM bw), unnest(generate_series(1, len(w) - n + 1)) AS t(i)
), hit AS (
  SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.phrase = bw.phrase
), cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(generate_series(i, i + n - 1)) AS t(p) GROUP BY doc_id
), item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN item USING (doc_id)
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)


ORACLE["op8_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)
), seen AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY words) AS first_doc FROM win
), gone AS (
  SELECT DISTINCT doc_id, p FROM seen, unnest(generate_series(i, i + 12)) AS t(p) WHERE first_doc < doc_id
), kept AS (
  SELECT doc_id, p, w[p] AS word FROM d, unnest(generate_series(1, len(w))) AS t(p)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.p = t.p)
), agg AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS words FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op9_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM d, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE c / (na.n + nb.n - c) >= 0.8
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, min(b) AS class_id, (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links,
       coalesce(any_value(n.n), 0) AS n_shingles
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


ORACLE["op3_lm_scores"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT doc_id, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v FROM d, unnest(generate_series(1, len(w))) AS t(i)
), uni AS (
  SELECT doc_id, w, count(*) AS own, sum(count(*)) OVER (PARTITION BY w) - count(*) AS others FROM t GROUP BY doc_id, w
), bi AS (
  SELECT doc_id, v, w, count(*) AS own, sum(count(*)) OVER (PARTITION BY v, w) - count(*) AS others
  FROM t WHERE v IS NOT NULL GROUP BY doc_id, v, w
), units AS (
  SELECT bi.doc_id, bi.own * CASE WHEN bi.others > 0 THEN round(ln(bi.others) * 1000000) - round(ln(c.others) * 1000000)
           ELSE round(ln(0.4) * 1000000) + CASE WHEN u.others > 0 THEN round(ln(u.others) * 1000000) ELSE round(ln(0.4) * 1000000) END END AS units,
         CASE WHEN bi.others > 0 THEN 0 ELSE bi.own END AS backed, CASE WHEN bi.others > 0 THEN 0 ELSE bi.own END AS by_word
  FROM bi JOIN uni AS c ON c.doc_id = bi.doc_id AND c.w = bi.v JOIN uni AS u ON u.doc_id = bi.doc_id AND u.w = bi.w
  UNION ALL
  SELECT t.doc_id, CASE WHEN u.others > 0 THEN round(ln(u.others) * 1000000) ELSE round(ln(0.4) * 1000000) END, 0, 1
  FROM t JOIN uni AS u ON u.doc_id = t.doc_id AND u.w = t.w WHERE v IS NULL
), s AS (
  SELECT doc_id, sum(units) AS units, sum(backed) AS backed, sum(by_word) AS by_word FROM units GROUP BY doc_id
), r AS (
  SELECT d.doc_id, len(w) AS n_tokens, CAST(coalesce(backed, 0) AS BIGINT) AS n_backoff,
         CAST(coalesce(units, 0) - coalesce(by_word, 0) * round(ln(greatest(sum(len(w)) OVER () - len(w), 1)) * 1000000) AS BIGINT) AS units
  FROM d LEFT JOIN s ON s.doc_id = d.doc_id
)
SELECT doc_id, n_tokens, n_backoff, units / 1000000 AS log_score,
       CASE WHEN n_tokens > 0 THEN round(units / 1000000 / n_tokens, 6) END AS mean_log_score
FROM r
"""


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _clusters_sql(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds written out: each assigns all vectors and takes exact floors of the means."""
    steps = [
        """WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS cluster, x AS c
  FROM v ORDER BY sha256('3:' || vec_id) NULLS LAST, x LIMIT {clusters}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(cluster, [d, cluster]) AS cluster, min(d) AS distance FROM (
    SELECT r, vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{n}) GROUP BY r
)""")
        if n < rounds:
            steps.append(f"""s{n} AS (
  SELECT cluster, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, unnest(generate_series(1, 64)) AS t(i) GROUP BY cluster, i
), m{n} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{n} GROUP BY cluster
), c{n + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster)
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


ORACLE["op11_centroid_clusters"] = _clusters_sql()


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


ORACLE["op12_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size,
         sha256(coalesce(CAST(doc_id AS VARCHAR), '-') || ',' || coalesce(sha256(text), '-') || ',' || coalesce(sha256(source), '-')) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source
), o AS (  -- in the order in which sources reach their limit as the share of a unit of weight grows
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k FROM s
), p AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(source_size) OVER () AS total FROM o
), u AS (
  SELECT (total - fixed) / free AS unit FROM p WHERE w * ((total - fixed) / free) < 3 * source_size ORDER BY k LIMIT 1
), r AS (
  SELECT source, source_size, least(w * coalesce((SELECT unit FROM u), 0), CAST(3 * source_size AS DOUBLE)) AS target,
         CASE WHEN source_size > 0 THEN least(least(w * coalesce((SELECT unit FROM u), 0), CAST(3 * source_size AS DOUBLE)) / source_size, 3.0) ELSE 0 END AS rate
  FROM s
), n AS (
  SELECT *, row_number() OVER (PARTITION BY key) - 1 AS occurrence FROM d
), t AS (
  SELECT doc_id, size, source_size, target, rate,
         CAST('0x' || substr(sha256('12,' || key || ',' || occurrence), 1, 13) AS BIGINT) / 4503599627370496 AS drawn
  FROM n JOIN r ON n.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END, 3) AS BIGINT) * size AS taken
FROM t
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (
  SELECT r, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER pair AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW pair AS (PARTITION BY p.r, p.other ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER pair <= 10
"""
