"""One registered query per corpus operator, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import language, personal
from gaugeline.llm.exact_dedup import exact_groups
from gaugeline.llm.language_model import scored
from gaugeline.llm.licenses import license_scan
from gaugeline.llm.mixing import mix
from gaugeline.llm.near_dedup import near_groups
from gaugeline.llm.neighbours import nearest
from gaugeline.llm.packing import pack
from gaugeline.llm.periodic import periodic_runs
from gaugeline.llm.resampling import resampled
from gaugeline.llm.sharding import shard
from gaugeline.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        LLM_QUERIES[name] = build
        return build

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model is fitted on; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language.fit(docs.filter(~held_out()))
    labelled = language.label(docs, model)
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")


@query("op2_exact_dedup")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir)).drop("row")


LLM_ORACLE["op2_exact_dedup"] = r"""
WITH named AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM named
WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).drop("row", "source")


LLM_ORACLE["op3_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::BIGINT AS share,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS left_weight
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, cap::HUGEINT * left_weight < share::HUGEINT * weight AS is_full FROM filled
), level AS (
  SELECT (sum(source_size) - coalesce(sum(cap) FILTER (is_full), 0))::BIGINT AS share,
         greatest(coalesce(sum(weight) FILTER (NOT is_full), 0), 1)::BIGINT AS of
  FROM marked
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE ELSE (weight * level.share)::DOUBLE / level.of::DOUBLE END AS target
  FROM marked, level
), placed AS (
  SELECT sized.doc_id, size, source_size, target,
         floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY sized.source
                                  ORDER BY md5(coalesce(sized.doc_id::VARCHAR, '')), sized.doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM placed
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, budget - whole * source_size - start)))::BIGINT AS taken
FROM passes
"""


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_documents(spark, sf_dir))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_documents(spark, sf_dir)).drop("row")


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(_documents(spark, sf_dir))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir))


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda value: value == kind


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = personal.personal_data(docs, personal.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    held = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(held, _is(k))).cast("bigint").alias(f"n_{k}") for k in personal.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(personal.joined(base), 256).alias("base_sha256"), personal.joined(F.col("spans")).alias("spans")
    )


def _id_hash(doc_id: str = "doc_id") -> Column:
    """CRC-32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


@query("op11_language_model")
def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(_documents(spark, sf_dir), _id_hash() % 7 != 2)
    return rows.withColumn("learned", ~F.col("learned")).withColumnRenamed("learned", "held_out")


@query("op12_resampling")
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampled(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.drop("n_words")


# CRC-32 of the bytes of text ``value`` in table ``{of}``, one division step per bit and byte.
_CRC = r"""
crc_table AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), crcs AS (
  SELECT value, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(digits) // 2),
           lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT value, hex(value) AS digits FROM {of}), crc_table
)"""

LLM_ORACLE["op12_resampling"] = (
    r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, NULL AS item_id, true AS is_corpus, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, item_id, false, text FROM benchmark
), found AS (
  SELECT row, is_corpus, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS value
  FROM texts
), """
    + _CRC.format(of="found")
    + r""", features AS (
  SELECT row, is_corpus, crc % 10000 AS bucket FROM found JOIN crcs USING (value)
), counts AS (
  SELECT bucket, count(*) FILTER (is_corpus) AS s, count(*) FILTER (NOT is_corpus) AS t FROM features GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (big_s + 10000) / ((s + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
  FROM counts, totals
), weights AS (
  SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM features JOIN gains USING (bucket)
  WHERE is_corpus GROUP BY row
), scored AS (
  SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT)
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE is_corpus
), ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row)
"""
)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_documents(spark, sf_dir), trial=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


LLM_ORACLE["op13_periodic_runs"] = (
    r"""
WITH ids AS (
  SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS value FROM documents
), """
    + _CRC.format(of="ids")
    + r""", texts AS (
  SELECT row_number() OVER () AS row, doc_id, crc AS h, crc // 10 AS g,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS list, len(list) AS n
  FROM documents JOIN crcs ON value = coalesce(doc_id::VARCHAR, '')
), placed AS (
  SELECT *, g % greatest(n, 1) AS a, 1 + (n - a) // (3 + g % 8) AS p FROM texts
), looped AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
           THEN list_transform(range(0, n), lambda i: list[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE list END AS list
  FROM placed
), fives AS (
  SELECT row, n, i, array_to_string(list[i + 1 : i + 5], ' ') AS five
  FROM (SELECT row, n, list, unnest(range(0, n - 4)) AS i FROM looped WHERE n >= 6)
), pairs AS (
  SELECT l.row, l.i, r.i - l.i AS period
  FROM fives l JOIN fives r ON l.row = r.row AND l.five = r.five AND r.i > l.i AND 4 * (r.i - l.i) <= l.n
), islands AS (
  SELECT row, period, i, i - row_number() OVER (PARTITION BY row, period ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT row, period, min(i) AS start, count(*) + 4 + period AS length FROM islands GROUP BY row, period, island
  HAVING count(*) + 4 + period >= greatest(6, 4 * period)
), runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.row = s.row AND t.period < s.period
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
), listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY row
), best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs t WHERE t.row = r.row
      AND (t.length * r.period > r.length * t.period
           OR (t.length * r.period = r.length * t.period AND (t.start, t.period) < (r.start, r.period))))
), dropped AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), words AS (
  SELECT row, unnest(list) AS word, unnest(range(0, n)) AS i FROM looped
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (row, i) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM looped LEFT JOIN listed USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)
"""
)
