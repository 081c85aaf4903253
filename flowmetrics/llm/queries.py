"""The operators applied to the driver's tables: one query per operator, and SQL where it can tell.

Every query reads its whole table and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmetrics.llm import (
    chat,
    curriculum,
    decontamination,
    filter_audit,
    jaccard_join,
    lm_scoring,
    packing,
    quality,
    repeats,
    resampling,
    sharding,
    token_files,
    url_filter,
)
from flowmetrics.llm.shipping import ship_package
from flowmetrics.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_reply_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    probe = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    rows = rows.unionByName(spark.createDataFrame(probe, "conv_id bigint, turn bigint, role string, text string"))
    path = scratch_path(spark, "conversations")
    chat.format_trees(chat.linear_conversations(rows), path)
    digests = chat.read_digests(spark.read.parquet(path))
    conv_id = F.when(F.col("tree") != "none", F.col("tree").cast("bigint"))
    return digests.select(
        conv_id.alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.drop("text_key")


def op3_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op4_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


#: Fixed by the query's contract.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_redirect_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = url_filter.judged_pages(pages, url_filter.rules_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.with_crc32(token_files.read_token_files(spark, path))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(_table(spark, sf_dir, "documents"))


#: Fixed by the query's contract: a plain rule beside the vote, which ``kept`` must pass too.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judged_documents(docs, drop_text=True)
    judged = judged.withColumn("base_failed", F.expr(BASE_FAILED))
    judged = judged.withColumn("kept", ~F.col("base_failed") & F.col("kept"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good",
    )


def op9_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharding.stratified_shards(rows, 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


#: Fixed by the query's contract: weights 3, 1 and 2. The first falls over the training, the second
#: stays, the third rises; a weight is its polygon's integral.
MIX_WEIGHTS = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 1.0), (1.0, 3.0)]]


def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = curriculum.sized_documents(docs, 29)
    mix = curriculum.mixed_documents(docs, curriculum.cycled_schedule(sized, MIX_WEIGHTS), sized=sized)
    return curriculum.taken_by_document(mix).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        F.coalesce("first_place", F.lit(-1)).alias("first_place"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_reply_paths": op1_reply_paths,
        "op2_string_tiling": op2_string_tiling,
        "op3_lattice_likelihood": op3_lattice_likelihood,
        "op4_slack_packing": op4_slack_packing,
        "op5_redirect_components": op5_redirect_components,
        "op6_token_files": op6_token_files,
        "op7_suffix_repeats": op7_suffix_repeats,
        "op8_quality_votes": op8_quality_votes,
        "op9_stratified_shards": op9_stratified_shards,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_curriculum_mix": op11_curriculum_mix,
        "op12_filter_audit": op12_filter_audit,
        "op13_target_resampling": op13_target_resampling,
    }


_OP1_SQL = """
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(role) + 24 +
    length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))) AS BIGINT)
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP5_SQL = """
WITH placed AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM placed
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS nth
  FROM parts JOIN rules ON starts_with(path, rule_path)
    AND (host = rule_host OR ends_with(host, '.' || rule_host))
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (page_id)
"""


_OP11_SQL = """
WITH docs AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5(concat_ws(':', '29', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS hash
  FROM documents
), sources AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY key) - 1 AS nth
  FROM docs GROUP BY key
), weighted AS (
  SELECT *, CASE nth % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
    CASE nth % 3 WHEN 0 THEN 4.5::DOUBLE ELSE 1.0::DOUBLE END AS w0,
    CASE nth % 3 WHEN 0 THEN -3.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS slope,
    CAST(2 * source_size AS DOUBLE) AS cap
  FROM sources
), filled AS (
  SELECT *, sum(cap) OVER early AS full_before, sum(w) OVER late AS free,
    1.5::DOUBLE * (SELECT sum(source_size) FROM sources) AS wanted
  FROM weighted WINDOW
    early AS (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    late AS (ORDER BY cap / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT wanted - coalesce(full_before, 0) AS rest, free FROM filled
  WHERE cap / w > (wanted - coalesce(full_before, 0)) / free ORDER BY cap / w, key LIMIT 1
), planned AS (
  SELECT key, source_size, w, w0, slope, least(cap, rest * w / free) AS target FROM weighted, level
), started AS (
  SELECT doc_id, key, size, hash, source_size, target, w, w0, slope,
    coalesce(sum(size) OVER (PARTITION BY key ORDER BY hash, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM docs JOIN planned USING (key)
), copies AS (
  SELECT *, least(size, CAST(floor(target) AS BIGINT) - copy * source_size - first) AS words,
    (copy * source_size + first) / target * w AS a
  FROM started, (VALUES (0), (1)) AS c(copy)
), ranked AS (
  SELECT *, row_number() OVER (
    ORDER BY coalesce(2 * a / (w0 + sqrt(w0 * w0 + 2 * slope * a)), 0), key, copy, hash, doc_id) - 1 AS place
  FROM copies WHERE words > 0
), taken AS (
  SELECT doc_id, sum(words) AS taken, count(*) AS copies, min(place) AS first_place
  FROM ranked GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken,
  CAST(coalesce(copies, 0) AS BIGINT) AS copies, CAST(coalesce(first_place, -1) AS BIGINT) AS first_place
FROM started LEFT JOIN taken USING (doc_id)
"""

_OP12_SQL = """
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), masked AS (
  SELECT doc_id, part,
    CAST(len(words) < 200 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY text) AS INTEGER) AS mask
  FROM worded
), labelled AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM masked LEFT JOIN labelled USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) AS v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.bit <> a.bit AND c.bit NOT IN (a.bit, b.bit) AND d.bit NOT IN (a.bit, b.bit, c.bit)
    AND e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), steps AS (
  SELECT filter_order, step, bit,
    (SELECT coalesce(sum(1 << p.bit), 0) FROM letters p
     WHERE strpos(filter_order, p.letter) < step) AS earlier
  FROM orders, range(1, 6) AS s(step), letters WHERE letter = substr(filter_order, step, 1)
), counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
    CAST(sum(n) FILTER (mask & (earlier | (1 << bit)) = 0) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (mask & earlier = 0 AND mask >> bit & 1 = 1) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (mask & earlier <> 0 AND mask >> bit & 1 = 1) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (mask = 1 << bit) AS BIGINT) AS unique_fails,
    CAST(sum(n_good) FILTER (mask & earlier = 0 AND mask >> bit & 1 = 1) AS BIGINT) AS good_lost,
    CAST(sum(n_toxic) FILTER (mask & earlier = 0 AND mask >> bit & 1 = 1) AS BIGINT) AS toxic_lost
  FROM kinds, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
  coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails,
  coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM counted
"""

_OP13_SQL = """
WITH crc AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT kind, id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM texts
), counted AS (
  SELECT kind, id, word, count(*) AS n FROM words GROUP BY ALL
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(strlen(word)), lambda i:
      CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM counted), crc
), sums AS (
  SELECT bucket, sum(n) FILTER (kind = 0) AS s, sum(n) FILTER (kind = 1) AS t
  FROM counted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    CAST((coalesce(t, 0) + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
      / CAST((coalesce(s, 0) + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM sums
), weights AS (
  SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features,
    CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id
), scores AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))
      AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS nth,
    10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn
  FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND nth <= drawn THEN nth END AS rank
FROM placed
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express.

    The SQL of the address filter leaves out links between pages, of which the driver's tables
    have none; the walk over links is tested on fixtures.
    """
    return {
        "op1_reply_paths": _OP1_SQL,
        "op5_redirect_components": _OP5_SQL,
        "op11_curriculum_mix": _OP11_SQL,
        "op12_filter_audit": _OP12_SQL,
        "op13_target_resampling": _OP13_SQL,
    }
