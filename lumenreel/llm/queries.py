"""The thin queries over the tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_table, click_sessions, jaccard_join, kmeans_tree, langid, line_templates, packing, probminhash, robust_quality, spelling_variants, substring_dedup, token_counts, url_rules

WORD_BPE, PIECE_BPE, END_ID = "word_bpe_49k.json", "piece_bpe_32k.model", 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = docs.where(~langid.held_out(F.col("doc_id")))
    model = langid.fit(known)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    got = bpe_table.decode(bpe_table.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


RULES = [
    url_rules.Rule("block", "com", "/en/"),
    url_rules.Rule("allow", "example.com", "/en/7"),
    url_rules.Rule("allow", "net", "/de/"),
    url_rules.Rule("block", "example.net", "/de/8"),
    url_rules.Rule("block", "org", "/es/"),
]


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no labels of URLs (``labels`` is of documents): what the given rules say of the
    URLs they fit is learned from."""
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


def url_rule_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op4 the given rules decide, for the check with SQL."""
    p = url_rules.parsed(table(spark, sf_dir, "pages").select("page_id", "url")).withColumn("fit", url_rules.fitting(RULES))
    return p.select(F.col("row.page_id").alias("page_id"), "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("given"))


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics of op9, for the check with SQL."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    d = robust_quality.base_statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *names)
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(PIECE_BPE)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed_digest(packing.pack_texts(docs, public_tokenizers.path(WORD_BPE), END_ID))


def op9_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return robust_quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_click_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_sessions.sessions(table(spark, sf_dir, "clicks"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_language_id,
            op2_bpe_round_trip,
            op3_substring_dedup,
            op4_url_rules,
            url_rule_parts,
            op5_line_dedup,
            op6_token_counts,
            op7_nearest_neighbours,
            op8_packing,
            op9_robust_quality,
            base_quality,
            op10_near_duplicates,
            op11_spelling_variants,
            op12_click_sessions,
            op13_jaccard_join,
        )
    }


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Windows of 35 words that start elsewhere too, and the words that they cover.
OP3_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
  s AS (SELECT k, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35), g AS (SELECT s.k, p, md5(array_to_string(w[p : p + 34], ' ')) AS h FROM s JOIN d USING (k)),
  r AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY h) AS n FROM g) WHERE n > 1), c AS (SELECT DISTINCT k, unnest(range(p, p + 35)) AS p FROM r),
  o AS (SELECT k, list(p) AS gone FROM c GROUP BY 1)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ') END) AS kept_sha256 FROM d LEFT JOIN o USING (k)"""

_RULES_SQL = "rule(verdict, host, path) AS (VALUES " + ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES) + ")"

URL_SQL = rf"""WITH {_RULES_SQL}, u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
  f AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS given FROM p JOIN rule r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY 1)
  SELECT p.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, given FROM p LEFT JOIN f USING (page_id)"""

BASE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
  s AS (SELECT k, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5), g AS (SELECT s.k, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] || ' ' || w[p + 4] AS h FROM s JOIN d USING (k)),
  r AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, h) AS n FROM g) WHERE n > 1), c AS (SELECT k, count(DISTINCT q) AS n FROM (SELECT k, unnest(range(p, p + 5)) AS q FROM r) GROUP BY 1),
  l AS (SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM d)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[ 	-
]+', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(c.n, 0) > 20 * len(w) AS base_failed FROM d JOIN l USING (k) LEFT JOIN c USING (k)"""


#: Hard breaks by windows, cuts by length one after the other.
OP12_SQL = """WITH RECURSIVE c AS (SELECT click_id, min(epoch_us(ts)) AS us, min(client_id) AS client_id, coalesce(bool_and(arrived_at > ts + INTERVAL 60 MINUTE), false) AS late,
    coalesce(bool_and(kind = 'purchase' AND value >= 60), false) AS final, coalesce(min(CAST(floor(100 * value + 0.5) AS BIGINT)), 0) AS cents FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1),
  k AS (SELECT *, row_number() OVER w AS rn, CASE WHEN lag(final) OVER w THEN 'end' WHEN us - lag(us) OVER w >= 300000000 THEN 'gap' END AS why FROM c WHERE NOT late WINDOW w AS (PARTITION BY client_id ORDER BY us, click_id)),
  r AS (SELECT *, count(why) OVER (PARTITION BY client_id ORDER BY rn) AS run FROM k),
  cut(client_id, run, rn, us) AS (SELECT client_id, run, rn, us FROM (SELECT *, row_number() OVER (PARTITION BY client_id, run ORDER BY rn) AS first FROM r) WHERE first = 1
    UNION ALL SELECT client_id, run, rn, us FROM (SELECT r.client_id, r.run, r.rn, r.us, row_number() OVER (PARTITION BY r.client_id, r.run ORDER BY r.rn) AS first FROM cut JOIN r ON r.client_id = cut.client_id AND r.run = cut.run AND r.us > cut.us + 7200000000) WHERE first = 1),
  s AS (SELECT *, lead(rn) OVER w AS upto, lead(us) OVER w AS next_us FROM cut WINDOW w AS (PARTITION BY client_id ORDER BY rn)),
  l AS (SELECT s.client_id, s.rn, count(*) AS n FROM s JOIN c ON c.client_id = s.client_id AND c.late AND c.us >= s.us AND (s.next_us IS NULL OR c.us < s.next_us) GROUP BY 1, 2),
  a AS (SELECT s.client_id, s.rn, s.upto, min(r.us) AS start_us, max(r.us) AS end_us, count(*) AS n_clicks, CAST(sum(r.cents) AS BIGINT) AS value_cents, arg_min(r.click_id, r.rn) AS session_id, arg_max(r.final, r.rn) AS final,
    sha256(string_agg(r.click_id, ',' ORDER BY r.rn)) AS path_sha256 FROM s JOIN r ON r.client_id = s.client_id AND r.rn >= s.rn AND (s.upto IS NULL OR r.rn < s.upto) GROUP BY 1, 2, 3)
  SELECT a.client_id, a.session_id, a.start_us, a.end_us, a.n_clicks, coalesce(l.n, 0) AS n_late, a.value_cents, CASE WHEN a.upto IS NULL THEN CASE WHEN a.final THEN 'end' ELSE 'none' END ELSE coalesce(n.why, 'length') END AS closed_by, a.path_sha256
  FROM a LEFT JOIN l USING (client_id, rn) LEFT JOIN r n ON n.client_id = a.client_id AND n.rn = a.upto"""


#: The checksum by its table; near words share what is left without one letter, or are what is left of one another.
OP11_SQL = r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
  r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
  c AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM r WHERE length(run) >= 7 GROUP BY 1, 2),
  h AS (SELECT run, n, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295), 4294967295) AS h FROM c, crc),
  w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1),
  words AS (SELECT * FROM w WHERE length(word) >= 7 AND n >= 2),
  v AS (SELECT word, n, length(word) AS l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
  near AS (SELECT a.word, b.word AS near, b.n AS m FROM v a JOIN v b ON a.d = b.d AND a.i = b.i AND a.l = b.l AND a.word <> b.word
    UNION SELECT v.word, words.word, words.n FROM v JOIN words ON words.word = v.d UNION SELECT words.word, v.word, v.n FROM v JOIN words ON words.word = v.d),
  best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1), top AS (SELECT word, n_near, best.m, min(near) AS near FROM best JOIN near USING (word, m) GROUP BY 1, 2, 3),
  f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN top USING (word)),
  up(word, root) AS (SELECT word, word FROM f UNION SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
  SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up USING (word) JOIN f g ON g.word = up.root AND g.form IS NULL"""

#: All pairs with a shingle in common are counted.
OP13_SQL = r"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT k, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] END AS g FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d WHERE len(w) > 0)),
  n AS (SELECT k, count(*) AS n FROM s GROUP BY 1), c AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2),
  l AS (SELECT a, b FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
  reached(k, r) AS (SELECT k, k FROM d UNION SELECT reached.k, l.b FROM reached JOIN l ON l.a = reached.r)
  SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id FROM d JOIN reached USING (k) JOIN d o ON o.k = reached.r LEFT JOIN n ON n.k = d.k GROUP BY d.k, d.doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others are models, tokenizers or plans, which SQL can't express; tests/llm has brute force."""
    return {"op3_substring_dedup": OP3_SQL, "url_rule_parts": URL_SQL, "base_quality": BASE_SQL, "op11_spelling_variants": OP11_SQL, "op12_click_sessions": OP12_SQL, "op13_jaccard_join": OP13_SQL}
