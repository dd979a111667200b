"""The corpus operators as queries over the test tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fuzzy_lines, langid, mixing, packing, periodic, quality, simhash, spelling, substrings, token_counts, token_ids, url_filter

Query = Callable[[SparkSession, str], DataFrame]

#: The query's tokenizers by name.
IDS, COUNTS = "word_bpe_49k.json", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(IDS))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTS))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTS))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Query]:
    own = (op1_simhash, op2_decontaminate, op3_mix, op4_substrings, op5_token_ids, op6_fuzzy_lines, op7_token_counts, op8_quality, op9_url_filter, op10_language)
    own += (op11_spelling, op12_packing, op13_periodic_runs)
    return {f.__name__: f for f in own}


#: The mix in SQL. The targets come from one pass over the sources by the ratio of cap and weight.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols
  FROM documents),
k AS (
  SELECT doc_id, source, CAST(size AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 1)
             / CAST(4503599627370496 AS DOUBLE)) / (1.0 / (1.0 + symbols / CAST(greatest(size, 1) AS DOUBLE))) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM k GROUP BY source),
o AS (
  SELECT *, 3 * source_size AS cap,
         sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 3 * source_size AS capped,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         sum(source_size) OVER () AS total
  FROM s),
l AS (SELECT coalesce(max(CAST(total - capped AS DOUBLE) / open) FILTER (WHERE CAST(total - capped AS DOUBLE) / open <= cap / weight), 0) AS share FROM o),
t AS (SELECT source, source_size, CAST(least(weight * share, CAST(cap AS DOUBLE)) AS DOUBLE) AS target FROM o, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
r AS (
  SELECT doc_id, size, source_size, target, epochs, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM r
"""

CONTAMINATION_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0 AND item IS NOT NULL),
bench AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS span
  FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
numbered AS (SELECT row_number() OVER () AS r, * FROM words),
spans AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS span
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM numbered, (SELECT DISTINCT n FROM bench))),
found AS (SELECT r, i, spans.n, item FROM spans JOIN bench USING (n, span)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM numbered LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

SUBSTRINGS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS span
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
low AS (SELECT *, min(doc_id) OVER (PARTITION BY span) AS least FROM win),
gone AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(generate_series(i, i + 12)) AS p FROM low WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL))),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS p FROM d)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

#: The crc32 goes byte by byte over a table of its 256 remainders; near words meet in the
#: strings that deleting a letter leaves (a replaced letter: at the same place).
SPELLING_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run
    FROM documents) GROUP BY 1, 2),
bytes AS (SELECT id, run, times, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, times FROM hashed),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE len(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
cut AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS p FROM v)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.rest = b.word),
best AS (
  SELECT a AS word, count(*) AS n_near, first(struct_pack(w := b, n := v.n) ORDER BY v.n DESC, b) AS x
  FROM pairs JOIN v ON v.word = b GROUP BY 1),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN x.n >= 10 * v.n THEN x.w END AS form, CASE WHEN x.n >= 10 * v.n THEN x.n END AS form_n
  FROM v LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.next)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN way ON way.word = f.word AND way.next IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_spelling": SPELLING_SQL, "op2_decontaminate": CONTAMINATION_SQL, "op3_mix": MIX_SQL, "op4_substrings": SUBSTRINGS_SQL}
