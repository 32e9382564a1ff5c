"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.alignment import alignment_digest
from tidewatch.llm.common import table
from tidewatch.llm.fingerprint import compare_neighbours
from tidewatch.llm.licenses import license_digest, scan_licenses
from tidewatch.llm.line_dedup import dedup_lines
from tidewatch.llm.mixing import mix_sources
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.pii import find_personal_data, personal_data_digest
from tidewatch.llm.pii import train as train_pii
from tidewatch.llm.secrets import scan_secrets
from tidewatch.llm.simhash import near_duplicates
from tidewatch.llm.token_file import document_digests, read_token_file, write_token_file
from tidewatch.llm.topk import top_k
from tidewatch.llm.toxicity import held_out, predicted, score_toxicity, train
from tidewatch.llm.variants import group_variants
from tidewatch.shared import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER, PIECE_TOKENIZER = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        LLM_QUERIES[function.__name__] = function
        if sql is not None:
            LLM_SQL[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_digest(scan_licenses(table(spark, folder, "documents")))


@query("""
WITH valid AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT vec_id, min(v) AS v FROM valid WHERE vec_id % 100 = 0 GROUP BY vec_id),
scored AS (
  SELECT a.vec_id AS query_id, c.vec_id, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM asked a JOIN valid c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
WHERE rank <= 10
""")
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


@query()
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


@query("""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS lost
  FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs, least_length=40, least_documents=5).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), TOKENIZER, end_id=2, size=4096)


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted(F.col("score")).alias("predicted")
    )


@query()
def op7_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return compare_neighbours(table(spark, folder, "documents"), k=64, words=5)


@query()
def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_file(table(spark, folder, "documents"), path, TOKENIZER, end_id=1)
    return document_digests(read_token_file(spark, path))


@query(r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
sources AS (
  SELECT *, (CASE (position - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END) AS weight FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS position
    FROM sized GROUP BY source)),
ratios AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio, sum(source_size) OVER () AS total,
    sum(weight) OVER () AS weights FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * total - coalesce(sum(cap) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ratios WINDOW before AS (ORDER BY ratio, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT l.*, least(cap::DOUBLE, weight * c.level) AS target
  FROM levels l, (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, position LIMIT 1) c),
source_quotients AS (
  SELECT position, target / (2 * n + 1) AS quotient, n
  FROM (SELECT position, target, unnest(range(0, (target / 16)::BIGINT + 40)) AS n FROM targets)),
source_quotas AS (
  SELECT position, count(*) AS quota FROM (
    SELECT position, row_number() OVER (ORDER BY quotient DESC, position, n) AS r FROM source_quotients)
  WHERE r <= (SELECT floor(1.5::DOUBLE * any_value(total) / 16 + 0.5) FROM targets) GROUP BY position),
dealt AS (
  SELECT s.*, t.position, t.source_size, t.target, ('0x' || substr(key, 1, 8))::BIGINT
    % greatest(1, ceil(t.source_size::DOUBLE / greatest(4096, ceil(t.total::DOUBLE / 4096)))::BIGINT) AS cell
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cells AS (SELECT position, cell, sum(size)::BIGINT AS cell_size FROM dealt GROUP BY ALL),
cell_quotients AS (
  SELECT position, cell, cell_size::DOUBLE / (2 * n + 1) AS quotient, n
  FROM (SELECT position, cell, cell_size, unnest(range(0, cell_size // 8 + 40)) AS n FROM cells)),
cell_quotas AS (
  SELECT position, cell, count(*) AS quota FROM (
    SELECT position, cell, row_number() OVER (PARTITION BY position ORDER BY quotient DESC, cell, n) AS r FROM cell_quotients)
  JOIN (SELECT position, quota AS source_quota FROM source_quotas) USING (position)
  WHERE r <= source_quota GROUP BY position, cell),
runs AS (
  SELECT position, cell, cell_size, w // cell_size AS copies, w % cell_size AS run,
    ('0x' || substr(md5('mix:' || position || ':' || cell), 1, 8))::BIGINT % cell_size AS begin_at
  FROM (SELECT *, least(16 * coalesce(quota, 0), 2 * cell_size) AS w FROM cells LEFT JOIN cell_quotas USING (position, cell))
  WHERE cell_size > 0),
placed AS (
  SELECT d.*, copies, run, begin_at, cell_size,
    (sum(size) OVER (PARTITION BY position, cell ORDER BY substr(key, 9, 24), doc_id, size
      ROWS UNBOUNDED PRECEDING))::BIGINT AS end_at
  FROM dealt d LEFT JOIN runs USING (position, cell))
SELECT doc_id, size, source_size, target, coalesce(copies * size
    + greatest(least(end_at, begin_at + run) - greatest(begin_at, end_at - size), 0)
    + greatest(least(end_at, begin_at + run - cell_size) - (end_at - size), 0), 0)::BIGINT AS taken
FROM placed
""")
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, limit=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=3, radius=2)


@query()
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_digest(table(spark, folder, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


@query()
def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return personal_data_digest(find_personal_data(docs, train_pii(docs)))


@query()
def op13_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    grouped = group_variants(docs, least_length=7, least_count=2, factor=10, drop_one_in=31)
    return grouped.select("word", "form", "root", "n", "n_near", "form_n")
