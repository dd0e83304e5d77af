"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.llm import (
    block_search, bpe, chat_format, decontaminate, line_dedup, multi_index, pii, simhash_dedup,
    spelling, substring_dedup, toxicity, url_filter, vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def keep(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan
    return keep


@query("op1_byte_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@query("op4_decontaminate", r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
asked AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(k) WHERE len(w) > 0),
windows AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT n FROM asked), unnest(range(1, len(w) - n + 2)) t(k) WHERE len(w) >= n),
found AS (SELECT doc_id, k, n, item FROM windows JOIN asked USING (n, s)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, k, n FROM found), unnest(range(k, k + n)) t(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@query("op2_pii")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, folder, "documents")))


@query("op3_block_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


#: a conversation whose texts hold control strings
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query("op5_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
    + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n')))
    AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"""SELECT * FROM VALUES
        (-1L, 0L, 'user', '{CONTROL}'), (-1L, 1L, 'assistant', '{CONTROL}')
        AS t(conv_id, turn, role, text)""")
    return chat_format.digest(chat_format.format_conversations(rows.union(extra)))


#: verdict, host and path of the URL rules
URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@query("op6_url_filter", """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(kind, on_host, under) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, p.host, p.path, arg_max(kind, length(on_host || under)) AS kind,
    arg_max(on_host || under, length(on_host || under)) AS rule
  FROM parts p LEFT JOIN rules r
    ON (p.host = on_host OR ends_with(p.host, '.' || on_host)) AND starts_with(p.path, under)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(kind, 'allow') AS verdict, false AS by_alias
FROM fits""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


@query("op7_line_dedup", """
WITH lines AS (
  SELECT doc_id, doc_id * 10000000 + k AS place, body
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
    unnest(range(len(string_split(text, chr(10))))) AS k FROM documents)),
d AS (
  SELECT body, string_split(body, ' ') AS w, len(string_split(body, ' ')) AS n, min(place) AS place
  FROM lines WHERE trim(body) <> '' GROUP BY body),
v AS (
  SELECT body, place, n, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:n]), ' ') AS rest
  FROM d, unnest(range(1, n + 1)) t(i) WHERE n >= 5),
near AS (
  SELECT body, min(place) OVER (PARTITION BY n, i, rest) AS place FROM v
  UNION ALL SELECT v.body, d.place FROM v JOIN d ON d.body = v.rest AND d.n = v.n - 1 AND d.n >= 5
  UNION ALL SELECT d.body, v.place FROM v JOIN d ON d.body = v.rest AND d.n = v.n - 1 AND d.n >= 5
  UNION ALL SELECT body, place FROM d),
earliest AS (SELECT body, min(place) AS first FROM near GROUP BY body),
kept AS (
  SELECT l.doc_id, l.place, l.body, e.first IS NULL OR l.place <= e.first AS stays
  FROM lines l LEFT JOIN earliest e ON e.body = l.body)
SELECT doc_id, coalesce(count(place), 0) AS n_lines,
  CAST(coalesce(sum(CASE WHEN NOT stays THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (WHERE stays), '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id) GROUP BY doc_id""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, folder, "documents")))


def fold() -> Column:
    """Fold of a row, by its ``doc_id``; labels of fold 1 are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = toxicity.learn(docs, table(spark, folder, "labels"), fold() != 1)
    return toxicity.score(docs.select("doc_id", "lang", "text"), net).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.threshold(net, F.col("lang"))).alias("rejected"))


@query("op9_simhash_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.digest(simhash_dedup.near_duplicates(table(spark, folder, "documents")))


@query("op10_substring_dedup", r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, k, array_to_string(w[k:k + 49], ' ') AS s
  FROM docs, unnest(range(1, len(w) - 48)) t(k) WHERE len(w) >= 50),
earliest AS (SELECT s, min(doc_id) AS holder FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, p FROM windows JOIN earliest USING (s), unnest(range(k, k + 50)) t(p)
  WHERE holder < doc_id),
islands AS (
  SELECT doc_id, min(p) - 1 AS a, max(p) AS b
  FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone)
  GROUP BY doc_id, g),
cuts AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, string_agg(a || ',' || b, ',' ORDER BY a) AS removed
  FROM islands GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, coalesce(removed, '') AS removed
FROM docs LEFT JOIN cuts USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(
        substring_dedup.remove_repeated(table(spark, folder, "documents")))


@query("op11_multi_index")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op12_spelling_variants", r"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT id, w, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w
    FROM documents)
  WHERE length(w) >= 6 GROUP BY id, w),
bytes AS (
  SELECT id, w, n, flatten(list_transform(string_split(id || ':' || w, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS b
  FROM runs),
checked AS (
  SELECT id, w, n, xor(list_reduce(b, lambda c, x: xor(c >> 8,
    list_reduce(range(8), lambda t, k: xor(t >> 1, 3988292384 * (t & 1)), xor(c, x) & 255)),
    CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM (SELECT id, w, n, list_transform(b, lambda x: CAST(x AS BIGINT)) AS b FROM bytes)),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word
    FROM checked)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) t(i)),
pairs AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM cuts a JOIN cuts b USING (i, rest)
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r,
    count(*) OVER (PARTITION BY word) AS n_near
  FROM pairs),
best AS MATERIALIZED (
  SELECT word, n_near, CASE WHEN m >= 5 * n THEN other END AS form,
    CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM ranked WHERE r = 1),
way AS (
  SELECT word, word AS tip, 0 AS step FROM words
  UNION ALL SELECT way.word, best.form, step + 1 FROM way JOIN best ON best.word = tip
  WHERE best.form IS NOT NULL),
ends AS (SELECT word, arg_max(tip, step) AS root FROM way GROUP BY word)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words JOIN ends USING (word) LEFT JOIN best USING (word)""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def lloyd_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """SQL of ``op13``: the rounds written out one after the other."""
    def nearest(n: int) -> str:
        return f"""
near{n} AS MATERIALIZED (
  SELECT k, p, CAST(min(entries_of * (own - 2 * list_inner_product(v, e) + size) + j) AS BIGINT) AS m
  FROM (SELECT k, p, v, list_inner_product(v, v) AS own, {entries} AS entries_of FROM cut)
  JOIN book{n} USING (p) GROUP BY k, p)"""

    def moved(n: int) -> str:
        return f"""
mean{n} AS (
  SELECT p, j, i, floor(sum(x) / count(*)) AS x
  FROM (SELECT k, p, m % {entries} AS j FROM near{n}) JOIN places USING (k, p) GROUP BY p, j, i),
book{n + 1} AS MATERIALIZED (
  SELECT p, j, coalesce(new.e, b.e) AS e, list_inner_product(coalesce(new.e, b.e), coalesce(new.e, b.e)) AS size
  FROM book{n} b LEFT JOIN (SELECT p, j, list(x ORDER BY i) AS e FROM mean{n} GROUP BY p, j) new
    USING (p, j))"""

    steps = ",".join(nearest(n) + "," + moved(n) for n in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS k
  FROM (SELECT vec_id, label, embedding,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
cut AS MATERIALIZED (
  SELECT k, p, w[p * len(w) // {parts} + 1:(p + 1) * len(w) // {parts}] AS v
  FROM kept, unnest(range({parts})) t(p)),
places AS MATERIALIZED (SELECT k, p, unnest(v) AS x, unnest(range(len(v))) AS i FROM cut),
book0 AS MATERIALIZED (
  SELECT p, k AS j, v AS e, list_inner_product(v, v) AS size FROM cut WHERE k < {entries}),
{steps},{nearest(rounds)},
found AS (
  SELECT k, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY p) AS code,
    CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM near{rounds} GROUP BY k),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(x AS BIGINT)), ','), ','
    ORDER BY p, j)) AS codebooks_sha256
  FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256
FROM kept JOIN found USING (k), books"""


@query("op13_vector_codes", lloyd_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.compress(table(spark, folder, "embeddings")))
