"""Registered queries of the text operators, with SQL oracles where SQL can express them.

Each query applies its operator, with production parameters, to the whole table and derives digest columns from the
operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.llm import (
    bpe_codec,
    exact_dedup,
    html_extraction,
    importance_resampling,
    license_scan,
    near_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    source_mix,
    substring_dedup,
    token_counts,
    whitening,
)

BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.grade(docs, model)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), threshold_pct=85)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("class_distance", "word_distance")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_crf"
    )


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    encoded = bpe_codec.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    decoded = bpe_codec.decode(encoded, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # NULL where the exact value, which the operator keeps, is beyond a long.
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
-- The level at which the k sources with the lowest cap by weight are clamped, for every k.
ranked AS (
  SELECT *, 3e0 * source_size / weight AS full_at,
    coalesce(sum(3e0 * source_size) OVER lower, 0e0) AS fixed,
    (SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER lower, 0) AS weights
  FROM sources WINDOW lower AS (ORDER BY 3e0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT ((SELECT sum(source_size) FROM sources) - fixed) / weights AS level FROM ranked
  WHERE ((SELECT sum(source_size) FROM sources) - fixed) / weights <= full_at
  ORDER BY full_at, source NULLS LAST LIMIT 1),
plan AS (
  SELECT source, source_size, least(weight * level, 3e0 * source_size) AS target,
    CASE WHEN source_size > 0 THEN CAST(floor(least(weight * level, 3e0 * source_size) / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM sources, level)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(whole * size + least(greatest(floor(target) - whole * source_size
    - coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY place, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0), size) AS BIGINT) AS taken
FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source
"""

OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, len(words) AS n_words, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)),
windows AS (
  SELECT doc_id, i AS e, CASE WHEN i >= 20 THEN list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS phrase
  FROM w),
repeats AS (
  SELECT doc_id, e, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, e) > 1 AS repeated FROM windows WHERE phrase IS NOT NULL),
judged AS (
  SELECT w.doc_id, w.i, w.word,
    coalesce(bool_or(repeated) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), false) AS gone
  FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id AND r.e = w.i)
SELECT d.doc_id, count(j.i) AS n_words, count(j.i) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(j.word, ' ' ORDER BY j.i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, x.b FROM reached r JOIN ways x ON r.other = x.a)
SELECT id AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, id = min(other) AS kept
FROM reached LEFT JOIN sizes ON sizes.doc_id = id GROUP BY id
"""

_CLASS_SETS = {
    "space": r"\x09-\x0D\x20", "small": "a-z", "capital": "A-Z", "digit": "0-9", "stop": ".,;:?!'\"()\\-",
    "symbol": r"#*$%&|<>@+=/\\^~_\[\]{}`", "two": r"\x{80}-\x{7FF}", "three": r"\x{800}-\x{FFFF}", "four": r"\x{10000}-\x{10FFFF}",
}


def _only(characters: str) -> str:
    """Number of characters of a text that belong to a set."""
    return "length(regexp_replace(text, '[^{}]', '', 'g'))".format(characters.replace("'", "''"))


_CLASS_ROWS = " UNION ALL ".join(f"SELECT doc_id, lang, '{n}' AS key, {_only(c)} AS n FROM d" for n, c in _CLASS_SETS.items())
_ALL_SETS = "".join(_CLASS_SETS.values())
_PART = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({0} + {1}) / 2e0)) ELSE 0e0 END"
_DISTANCE = f"sqrt(greatest((sum({_PART.format('p', 'q')}) + sum({_PART.format('q', 'p')})) / 2e0, 0e0))"
OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, lang, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
triples AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n
  FROM (SELECT doc_id, i, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE third IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM triples, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
totals AS (SELECT lang, count(*) AS total FROM w GROUP BY lang),
-- Languages with enough words have references; documents of the others are not judged by divergence.
known AS (SELECT lang FROM totals WHERE total >= 10000),
class_n AS (
  {_CLASS_ROWS} UNION ALL SELECT doc_id, lang, 'other', length(text) - {_only(_ALL_SETS)} FROM d),
class_ref AS (
  SELECT lang, key, n / sum(n) OVER (PARTITION BY lang) AS q FROM (SELECT lang, key, sum(n) AS n FROM class_n WHERE lang IN (FROM known) GROUP BY ALL)),
class_js AS (
  SELECT doc_id, {_DISTANCE} AS js FROM (
    SELECT doc_id, c.n / nullif(sum(c.n) OVER (PARTITION BY doc_id), 0) AS p, q FROM class_n c JOIN class_ref f ON f.lang = c.lang AND f.key = c.key)
  GROUP BY doc_id),
word_ref AS (
  SELECT lang, word, n / total AS q FROM (
    SELECT lang, word, count(*) AS n, any_value(total) AS total FROM w JOIN totals USING (lang) WHERE lang IN (FROM known) GROUP BY ALL)
  WHERE n * 500 >= total),
word_n AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL),
word_pq AS (
  SELECT d.doc_id, coalesce(n, 0) / len(words) AS p, q
  FROM d JOIN word_ref f ON f.lang = d.lang LEFT JOIN word_n c ON c.doc_id = d.doc_id AND c.word = f.word WHERE len(words) > 0),
word_js AS (
  SELECT doc_id, {_DISTANCE} AS js FROM (
    FROM word_pq UNION ALL SELECT doc_id, greatest(1 - sum(p), 0e0), greatest(1 - sum(q), 0e0) FROM word_pq GROUP BY doc_id) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
    {_only("#*$%&|<>")} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= 100 AND (coalesce(c.js, 0) > 0.3 OR coalesce(x.js, 0) > 0.45)) AS kept
FROM judged LEFT JOIN class_js c USING (doc_id) LEFT JOIN word_js x USING (doc_id)
"""

OP10_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The given pages all declare their article, so SQL can cut it out by its element; the operator does not rely on that.
OP11_SQL = r"""
WITH parts AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS part FROM pages),
texts AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(part, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM parts)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""

# crc32 by half bytes: the 16 remainders of the polynomial (fixed values), low half of each byte first.
_CRC_SQL = """list_reduce(list_concat([4294967295], list_transform(range(1, length(hx) + 1),
    lambda j: CAST(instr('123456789ABCDEF', hx[j + CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END]) AS BIGINT))),
    lambda c, n: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(xor(c, n) & 15) + 1]))"""
OP13_SQL = rf"""
WITH texts AS (SELECT false AS wanted, doc_id, text FROM documents UNION ALL SELECT true, item_id, text FROM benchmark),
w AS (
  SELECT wanted, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
features AS (
  SELECT wanted, doc_id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
hashed AS (SELECT feature, xor({_CRC_SQL}, 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT feature, hex(encode(feature)) AS hx FROM features)),
counts AS (SELECT bucket, count(*) FILTER (WHERE NOT wanted) AS s, count(*) FILTER (WHERE wanted) AS t FROM features JOIN hashed USING (feature) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts, totals),
sums AS (SELECT doc_id, sum(gain) AS gain, count(*) AS n FROM features JOIN hashed USING (feature) JOIN gain USING (bucket) WHERE NOT wanted GROUP BY doc_id),
weighed AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN CAST((gain - ((gain % n) + n) % n) // n AS BIGINT) ELSE 0 END AS weight,
    CAST('0x' || substr(sha256('7:' || CAST(w.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN sums USING (doc_id) WHERE NOT wanted),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_source_mix": op3_source_mix,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_license_scan": op6_license_scan,
    "op7_secret_scan": op7_secret_scan,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_token_counts": op9_token_counts,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLES: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_source_mix": OP3_SQL,
    "op4_near_dedup": OP4_SQL,
    "op5_quality_rules": OP5_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_html_extraction": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}
