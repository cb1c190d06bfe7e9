"""The registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm._common import table
from eventlake.llm.bpe import decoded, encoded
from eventlake.llm.chat import chat_windows, read_back
from eventlake.llm.decontaminate import contamination
from eventlake.llm.hard_negatives import hard_negatives, integer_vectors
from eventlake.llm.html_text import extracted
from eventlake.llm.line_dedup import line_dedup
from eventlake.llm.merkle import edited_range, fingerprint, likeness, merkle_tree, with_next
from eventlake.llm.near_dedup import near_duplicates
from eventlake.llm.pii import KINDS, personal_spans, span_list
from eventlake.llm.sharding import sharded
from eventlake.llm.token_alignment import aligned
from eventlake.llm.toxicity import toxicity
from eventlake.llm.url_filter import judged

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = encoded(docs, RANKS).select("row.doc_id", "n_tokens", "ids")
    return decoded(tokens, RANKS).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = span_list(F.filter("spans", lambda s: ~s["disguised"]))
    return found.select("row.doc_id", *[of(k) for k in KINDS], F.sha2(base, 256).alias("base_sha256"), span_list("spans").alias("spans"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), 8)


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    docs = docs.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_print", edited.alias("edited"))
    docs = docs.select("*", merkle_tree(F.col("edited")).alias("tree")).select("*", fingerprint(F.col("tree")).alias("edited_fingerprint"))
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
        edited_range(F.col("fingerprint"), F.col("edited_fingerprint")).alias("edited_paragraphs"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.size("removed").cast("long").alias("n_removed")
    return found.select("row.doc_id", "n_lines", gone, F.array_join(F.transform("removed", lambda k: k.cast("string")), ",").alias("removed"), F.sha2("text", 256).alias("text_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(chat_windows(turns))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: Fixed values of the query: verdict, host and path of each rule.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("select * from values " + ", ".join(map(str, URL_RULES)) + " as t(verdict, host, path)")
    found = judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, label = table(spark, sf_dir, "embeddings"), F.col("label").cast("long")
    noisy = v.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(integer_vectors(noisy), F.col("vec_id") % 50 == 0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_byte_bpe,
        op3_pii,
        op4_sharding,
        op5_merkle,
        op6_html_text,
        op7_toxicity,
        op8_line_dedup,
        op9_decontamination,
        op10_chat_format,
        op11_url_filter,
        op12_hard_negatives,
        op13_token_alignment,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": rf"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sized AS (SELECT doc_id, w, least(5, len(w)) AS size FROM worded WHERE len(w) > 0),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + size - 1], ' ') AS s FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM sized)),
n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) r USING (doc_id)
""",
    "op9_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS size FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS key FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM i)),
dw AS (SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS key FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
m AS (SELECT doc_id, item_id, p, size FROM dw JOIN iw USING (size, key)),
hit AS (SELECT doc_id, count(DISTINCT h) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS h FROM m) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(item.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
""",
    "op8_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM split),
worded AS (SELECT doc_id, pos, list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[ \t\n\x0B\f\r]+'), lambda w: w <> ''))) AS w FROM line),
big AS (SELECT doc_id, pos, w, len(w) AS n FROM worded WHERE len(w) >= 1),
sets AS (SELECT w, any_value(n) AS n, min((doc_id, pos)) AS at, row_number() OVER () AS sid FROM big GROUP BY w),
word AS (SELECT sid, n, unnest(w) AS t FROM sets),
rarity AS (SELECT t, count(*) AS c FROM word GROUP BY t),
placed AS (SELECT word.sid, word.n, word.t, row_number() OVER (PARTITION BY word.sid ORDER BY c, word.t) AS r FROM word JOIN rarity USING (t)),
prefix AS (SELECT sid, n, t FROM placed WHERE r <= n - ceil(n * 0.75) + 1),
pair AS (SELECT DISTINCT a.sid AS a, b.sid AS b FROM prefix a JOIN prefix b ON a.t = b.t AND a.sid <> b.sid WHERE 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n),
gone AS (SELECT DISTINCT l.sid FROM pair JOIN sets e ON e.sid = pair.a JOIN sets l ON l.sid = pair.b
  WHERE e.at < l.at AND 4 * len(list_intersect(e.w, l.w)) >= 3 * (e.n + l.n - len(list_intersect(e.w, l.w)))),
removed AS (SELECT big.doc_id, list(big.pos ORDER BY big.pos) AS r FROM big JOIN sets USING (w) LEFT JOIN gone ON gone.sid = sets.sid
  WHERE gone.sid IS NOT NULL OR (big.doc_id, big.pos) <> sets.at GROUP BY big.doc_id)
SELECT split.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(r), 0) AS BIGINT) AS n_removed,
  coalesce(array_to_string(r, ','), '') AS removed,
  sha256(CASE WHEN r IS NULL THEN array_to_string(lines, chr(10)) ELSE coalesce(array_to_string(list_transform(list_filter(range(0, len(lines)), lambda i: NOT list_contains(r, i)), lambda i: lines[i + 1]), chr(10)), '') END) AS text_sha256
FROM split LEFT JOIN removed USING (doc_id)
""",
    "op11_url_filter": rf"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cased AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cased),
rules AS (SELECT * FROM (VALUES {", ".join(map(str, URL_RULES))}) t(verdict, rule_host, rule_path)),
fit AS (SELECT page_id, arg_max((rule_host || rule_path, verdict), length(rule_host || rule_path)) AS f FROM parts JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, f[1] AS rule, coalesce(f[2], 'allow') AS verdict FROM parts LEFT JOIN fit USING (page_id)
""",
    "op12_hard_negatives": r"""
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3
""",
}
