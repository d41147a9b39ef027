"""Queries of text functions: subtitle lines, replies, errors, settings, headers, prompts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import register
from ..functions import text as X
from ..session import table


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


@register(
    "line_breaks",
    r"""WITH t AS (SELECT conv_id, turn, text, length(text) // 2 AS mid, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS words FROM conversations),
      s AS (SELECT *, list_transform(range(1, len(words) + 1), lambda i: CAST(list_sum(list_transform(words[1:i], lambda w: length(w) + 1)) AS BIGINT)) AS sums FROM t),
      b AS (SELECT *, list_prepend(0, sums) AS c FROM s),
      p AS (SELECT *, c[list_position(list_transform(c, lambda x: abs(x - mid)), list_min(list_transform(c, lambda x: abs(x - mid))))] AS cut FROM b)
      SELECT conv_id, turn, CASE WHEN length(text) <= 42 THEN text ELSE regexp_replace(substr(text, 1, cut), '^\s+|\s+$', '', 'g') || chr(10) || regexp_replace(substr(text, cut + 1), '^\s+|\s+$', '', 'g') END AS lines FROM p""",
)
def line_breaks(spark, sf_dir):
    """Subtitle texts in two lines."""
    return conversations(spark, sf_dir).select("conv_id", "turn", X.two_lines(F.col("text")).alias("lines"))


_REPLIES = r"""reply AS (SELECT conv_id, turn, CASE turn % 6 WHEN 0 THEN '```json' || chr(10) || '["a", "' || role || '", 1, null, true]' || chr(10) || '```'
    WHEN 1 THEN 'Sure: ["' || role || '"] there' WHEN 2 THEN '{"a": 1}' WHEN 3 THEN 'none' WHEN 4 THEN '[]' ELSE '```' || chr(10) || '[1.5, false, "x"]```' END AS reply FROM conversations)"""


@register(
    "reply_arrays",
    rf"""WITH {_REPLIES}, b AS (SELECT *, trim(regexp_replace(regexp_replace(trim(reply), '^```(json)?\s*', ''), '\s*```$', '')) AS bare FROM reply),
      c AS (SELECT *, CASE WHEN json_valid(bare) AND json_type(bare) = 'ARRAY' THEN bare WHEN json_valid(regexp_extract(bare, '(?s)\[.*\]')) THEN regexp_extract(bare, '(?s)\[.*\]') END AS j FROM b)
      SELECT conv_id, turn, array_to_string(list_transform(range(0, CAST(json_array_length(j) AS BIGINT)), lambda i: CASE json_type(j, '$[' || i || ']') WHEN 'NULL' THEN 'None' WHEN 'BOOLEAN' THEN
        CASE json_extract_string(j, '$[' || i || ']') WHEN 'true' THEN 'True' ELSE 'False' END ELSE json_extract_string(j, '$[' || i || ']') END), '|') AS items FROM c""",
)
def reply_arrays(spark, sf_dir):
    """Arrays of strings out of a model's replies."""
    k = F.col("turn") % 6
    role, nl = F.col("role"), F.lit("\n")
    reply = F.when(k == 0, F.concat(F.lit("```json\n[\"a\", \""), role, F.lit('", 1, null, true]\n```'))).when(k == 1, F.concat(F.lit('Sure: ["'), role, F.lit('"] there')))
    reply = reply.when(k == 2, '{"a": 1}').when(k == 3, "none").when(k == 4, "[]").otherwise(F.concat(F.lit("```"), nl, F.lit('[1.5, false, "x"]```')))
    c = conversations(spark, sf_dir).withColumn("reply", reply)
    return c.select("conv_id", "turn", F.array_join(X.json_strings(F.col("reply")), "|").alias("items"))


@register(
    "drawn_texts",
    r"""SELECT conv_id, turn, replace(replace(replace(replace(nfc_normalize(t), '\', '\\'), '''', '’'), ':', '\:'), '%', '%%') AS drawn FROM (
      SELECT *, text || CASE turn % 3 WHEN 0 THEN ' 50%: it''s \n' WHEN 1 THEN ' e' || chr(769) ELSE '' END AS t FROM conversations)""",
)
def drawn_texts(spark, sf_dir):
    """Texts escaped for a drawing filter."""
    k = F.col("turn") % 3
    tail = F.when(k == 0, r" 50%: it's \n").when(k == 1, " é").otherwise("")
    return conversations(spark, sf_dir).select("conv_id", "turn", X.drawtext(F.concat("text", tail)).alias("drawn"))


@register(
    "filled_templates",
    """SELECT c_custkey, replace(replace(replace('Get {app}: {cta}! {tagline}{app}', '{app}', coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, 'the app')),
      '{cta}', coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'Download now')), '{tagline}', coalesce(CASE WHEN c_custkey % 5 = 0 THEN 'now ' END, '')) AS script FROM customer""",
)
def filled_templates(spark, sf_dir):
    k = F.col("c_custkey")
    script = X.template(F.lit("Get {app}: {cta}! {tagline}{app}"), F.when(k % 2 == 0, F.col("c_name")), F.when(k % 3 == 0, F.col("c_mktsegment")), F.when(k % 5 == 0, "now "))
    return table(spark, sf_dir, "customer").select("c_custkey", script.alias("script"))


_ERRORS = r"""error AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '429 RESOURCE_EXHAUSTED {"retryDelay": "' || event_id % 50 || 's"}' WHEN 1 THEN 'Retrying in ' || event_id % 30 || 's, please'
    WHEN 2 THEN 'rate limit reached, retry in 0s' WHEN 3 THEN 'Rate Limit   hit' WHEN 4 THEN 'quota' || chr(10) || 'used up' WHEN 5 THEN 'broken pipe' ELSE 'retryDelay=9s retry in 4s' END AS error FROM events)"""


@register(
    "error_texts",
    rf"""WITH {_ERRORS}, f AS (SELECT *, regexp_extract(error, 'retryDelay\\?"?\s*[:=]\s*\\?"?(\d+)s', 1) AS a, regexp_extract(error, '(?i)retry(?:ing)?\s+in\s+(\d+)s', 1) AS b FROM error)
      SELECT event_id, CASE WHEN a <> '' THEN greatest(1, CAST(a AS INT)) WHEN b <> '' THEN greatest(1, CAST(b AS INT)) ELSE 5 END AS seconds,
        contains(error, '429') OR contains(error, 'RESOURCE_EXHAUSTED') OR contains(error, 'rate_limit') OR contains(error, 'too many requests') OR contains(error, 'quota') OR contains(error, 'rate limit') AS limited,
        CASE WHEN length(trim(regexp_replace(error, '\s+', ' ', 'g'))) > 20 THEN substr(trim(regexp_replace(error, '\s+', ' ', 'g')), 1, 17) || '...' ELSE trim(regexp_replace(error, '\s+', ' ', 'g')) END AS short FROM f""",
)
def error_texts(spark, sf_dir):
    """Delay, kind and short form of error texts."""
    k, num = F.col("event_id") % 7, lambda n: (F.col("event_id") % n).cast("string")
    e = F.when(k == 0, F.concat(F.lit('429 RESOURCE_EXHAUSTED {"retryDelay": "'), num(50), F.lit('s"}'))).when(k == 1, F.concat(F.lit("Retrying in "), num(30), F.lit("s, please")))
    e = e.when(k == 2, "rate limit reached, retry in 0s").when(k == 3, "Rate Limit   hit").when(k == 4, "quota\nused up").when(k == 5, "broken pipe").otherwise("retryDelay=9s retry in 4s")
    t = table(spark, sf_dir, "events").select("event_id", e.alias("error"))
    return t.select("event_id", X.retry_seconds(F.col("error")).alias("seconds"), X.rate_limited(F.col("error")).alias("limited"), X.compact(F.col("error"), 20).alias("short"))


@register(
    "settings",
    """SELECT p_partkey, lower(trim(v)) IN ('1', 'true', 'yes', 'on') AS enabled, coalesce(TRY_CAST(n AS INT), 7) AS count, coalesce(TRY_CAST(f AS DOUBLE), 0.5) AS share FROM (
      SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN ' Yes' WHEN 1 THEN 'ON' WHEN 2 THEN '1' WHEN 3 THEN 'no' WHEN 4 THEN 'true ' ELSE '' END AS v,
        CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN 'many' WHEN 2 THEN NULL ELSE '-3' END AS n, CASE p_size % 3 WHEN 0 THEN '1.25' WHEN 1 THEN 'x' END AS f FROM part)""",
)
def settings(spark, sf_dir):
    """Switches and numbers out of setting texts."""
    s = F.col("p_size")
    v = F.when(s % 6 == 0, " Yes").when(s % 6 == 1, "ON").when(s % 6 == 2, "1").when(s % 6 == 3, "no").when(s % 6 == 4, "true ").otherwise("")
    n = F.when(s % 4 == 0, s.cast("string")).when(s % 4 == 1, "many").when(s % 4 == 3, "-3")
    f = F.when(s % 3 == 0, "1.25").when(s % 3 == 1, "x")
    return table(spark, sf_dir, "part").select("p_partkey", X.truthy(v).alias("enabled"), X.number_or(n, "int", F.lit(7)).alias("count"), X.number_or(f, "double", F.lit(0.5)).alias("share"))


@register(
    "token_lists",
    """SELECT p_partkey, array_to_string(t, ',') AS tokens, array_to_string(list_filter(t, lambda x: x NOT IN ('en', 'de', 'fr')), ',') AS invalid FROM (
      SELECT p_partkey, list_filter(l, lambda x, i: list_position(l, x) = i) AS t FROM (
        SELECT p_partkey, list_filter(list_transform(string_split(CASE p_size % 3 WHEN 0 THEN ' en, de ,,en' WHEN 1 THEN 'xx,fr,' || p_brand ELSE '' END, ','), lambda x: trim(x)), lambda x: x <> '') AS l FROM part))""",
)
def token_lists(spark, sf_dir):
    """Comma lists in order, each item once, and the items that aren't known."""
    s = F.col("p_size") % 3
    spec = F.when(s == 0, " en, de ,,en").when(s == 1, F.concat(F.lit("xx,fr,"), "p_brand")).otherwise("")
    t = X.tokens(spec)
    known = F.array(F.lit("en"), F.lit("de"), F.lit("fr"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(t, ",").alias("tokens"), F.array_join(F.array_except(t, known), ",").alias("invalid"))


@register(
    "header_lines",
    r"""SELECT doc_id, CASE WHEN regexp_matches(t, '(?m)^Language:') THEN regexp_extract(t, '(?s)\A((?:.*?\n)??)Language:\s*[^\n]*(.*)\z', 1) || 'Language: Deutsch' || regexp_extract(t, '(?s)\A((?:.*?\n)??)Language:\s*[^\n]*(.*)\z', 2)
        ELSE 'Language: Deutsch' || chr(10) || t END AS body FROM (
      SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Title' || chr(10) || 'Language: x' || chr(10) || 'Language: y' WHEN 1 THEN 'Language:' || chr(10) || 'next' || chr(10) || 'end' WHEN 2 THEN 'My Language: z' ELSE lang END AS t FROM documents)""",
)
def header_lines(spark, sf_dir):
    """A header line set: the first one replaced, or put in front."""
    k = F.col("doc_id") % 4
    t = F.when(k == 0, "Title\nLanguage: x\nLanguage: y").when(k == 1, "Language:\nnext\nend").when(k == 2, "My Language: z").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", X.header_line(t, F.lit("Deutsch")).alias("body"))


@register(
    "glyph_coverage",
    """SELECT doc_id, round(CASE WHEN len(c) = 0 THEN 1.0 ELSE len(list_filter(c, lambda x: x IN ('é', 'ä', 'ñ', 'ö'))) * 1.0 / len(c) END, 6) AS share, regexp_matches(text, '[一-鿿぀-ゟ゠-ヿ가-힯]') AS cjk FROM (
      SELECT *, list_distinct(regexp_extract_all(text, '[^\\x00-\\x7F]')) AS c FROM (SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN ' éñ→' WHEN 1 THEN ' 漢' ELSE '' END AS text FROM documents))""",
)
def glyph_coverage(spark, sf_dir):
    """How many of the characters beyond ASCII a font has, and whether a text is Chinese, Japanese or Korean."""
    k = F.col("doc_id") % 3
    t = F.concat("text", F.when(k == 0, " éñ→").when(k == 1, " 漢").otherwise(""))
    have = F.array(*map(F.lit, "éäñö"))
    return table(spark, sf_dir, "documents").select("doc_id", t.alias("t")).select("doc_id", F.round(X.coverage(F.col("t"), have), 6).alias("share"), X.cjk(F.col("t")).alias("cjk"))


@register(
    "nested_specs",
    """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_ids, CASE WHEN p_size % 3 = 0 THEN '5.0,26.0' END AS first_at,
      array_to_string(list_transform(range(0, CAST(floor((p_size % 7) / 0.5 + 1e-6) AS BIGINT) + 1), lambda i: round_even(p_size + i * 0.5, 2)), ' ') AS times FROM part""",
)
def nested_specs(spark, sf_dir):
    """Lists of numbers by id, and windows as stepped times."""
    s = F.col("p_size")
    spec = F.when(s % 3 == 0, "1:5, 26;13:23,;junk").when(s % 3 == 1, "4: 1").otherwise("junk")
    m = X.nested_lists(spec)
    times = X.stepped(s.cast("double"), s.cast("double") + s % 7, 0.5)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(m).alias("n_ids"), F.array_join(F.try_element_at(m, F.lit("1")).cast("array<string>"), ",").alias("first_at"), F.array_join(times.cast("array<string>"), " ").alias("times"))


@register(
    "wrapped_lines",
    """WITH RECURSIVE w AS (SELECT p_partkey, list_filter(string_split(p_name || ' ' || p_type, ' '), lambda x: x <> '') AS words FROM part),
      r AS (SELECT p_partkey, words, 1 AS i, [words[1]] AS lines FROM w UNION ALL
        SELECT p_partkey, words, i + 1, CASE WHEN (length(lines[-1]) + 1 + length(words[i + 1])) * 8.0 > 90 THEN list_append(lines, words[i + 1]) ELSE list_append(lines[1:len(lines) - 1], lines[-1] || ' ' || words[i + 1]) END FROM r WHERE i < len(words))
      SELECT p_partkey, array_to_string(lines, '/') AS lines, CAST(len(lines) AS INT) AS n FROM r WHERE i = len(words)""",
)
def wrapped_lines(spark, sf_dir):
    """Words in lines of a width."""
    lines = X.wrapped(F.concat_ws(" ", "p_name", "p_type"), F.lit(90), F.lit(8.0))
    return table(spark, sf_dir, "part").select("p_partkey", lines.alias("l")).select("p_partkey", F.array_join("l", "/").alias("lines"), F.size("l").alias("n"))


@register(
    "fitting_sizes",
    """WITH RECURSIVE w AS (SELECT p_partkey, p_size, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS words, unnest(range(10, 41)) AS z FROM part),
      r AS (SELECT p_partkey, p_size, z, words, 1 AS i, length(words[1]) AS wide, 1 AS n FROM w UNION ALL
        SELECT p_partkey, p_size, z, words, i + 1, CASE WHEN (wide + 1 + length(words[i + 1])) * (z * CAST(0.55 AS DOUBLE)) > 100 + p_size THEN length(words[i + 1]) ELSE wide + 1 + length(words[i + 1]) END,
          n + CASE WHEN (wide + 1 + length(words[i + 1])) * (z * CAST(0.55 AS DOUBLE)) > 100 + p_size THEN 1 ELSE 0 END FROM r WHERE i < len(words))
      SELECT p_partkey, CAST(coalesce(max(z) FILTER (n * (z + 4) <= 40 + p_size % 30), 10) AS INT) AS size FROM r WHERE i = len(words) GROUP BY 1""",
)
def fitting_sizes(spark, sf_dir):
    """The largest font size that fits a box."""
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", X.largest_size(F.col("p_name"), 100 + s, 40 + s % 30, 10, 40).alias("size"))


@register(
    "prompts",
    """WITH r AS (SELECT conv_id, turn, text, CAST((row_number() OVER w - 1) // 3 AS BIGINT) AS batch, row_number() OVER w AS rn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)),
      b AS (SELECT conv_id, batch, min(rn) AS lo, max(rn) AS hi, string_agg('  ' || ((rn - 1) % 3 + 1) || '. "' || text || '"', chr(10) ORDER BY rn) AS body FROM r GROUP BY 1, 2),
      c AS (SELECT b.conv_id, b.batch, string_agg('  [' || (r.rn - greatest(b.lo - 2, 1) + 1) || '] "' || r.text || '"', chr(10) ORDER BY r.rn) FILTER (r.rn < b.lo) AS before,
        string_agg('  [' || (r.rn - b.hi) || '] "' || r.text || '"', chr(10) ORDER BY r.rn) FILTER (r.rn > b.hi) AS after
        FROM b JOIN r ON r.conv_id = b.conv_id AND r.rn BETWEEN b.lo - 2 AND b.hi + 2 GROUP BY 1, 2)
      SELECT conv_id, batch, md5('Translate the following subtitle segments from en to de.' || chr(10) || 'Return ONLY a JSON array of translated strings, matching the input order.'
        || coalesce(chr(10) || chr(10) || 'Context (previous segments, do NOT translate these):' || chr(10) || before, '') || chr(10) || chr(10) || 'Segments to translate:' || chr(10) || body
        || coalesce(chr(10) || chr(10) || 'Context (following segments, do NOT translate these):' || chr(10) || after, '')) AS prompt_md5, len(body) > 0 AS filled FROM b JOIN c USING (conv_id, batch)""",
)
def prompts(spark, sf_dir):
    """A prompt for each batch of segments, with up to two before and after it."""
    from ..operators import numbering

    b = numbering.batches(conversations(spark, sf_dir), ["conv_id"], ["turn", "text"], 3, "text")
    return b.select("conv_id", "batch", F.md5(X.prompt(F.lit("en"), F.lit("de"), F.col("texts"), F.col("before"), F.col("after"))).alias("prompt_md5"), (F.size("texts") > 0).alias("filled"))


@register(
    "renumbered",
    """SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, said) AS BIGINT) AS n, said FROM (
      SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN role ELSE text END AS said FROM conversations) WHERE said <> ''""",
)
def renumbered(spark, sf_dir):
    """Segments without text go and leave no gap: the translation where there is one, even an empty
    one, else the original."""
    c = conversations(spark, sf_dir).withColumn("translations", F.when(F.col("turn") % 3 == 0, F.create_map(F.lit("de"), F.lit(""))).when(F.col("turn") % 3 == 1, F.create_map(F.lit("de"), F.col("role"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    said = F.when(F.map_contains_key("translations", "de"), F.try_element_at("translations", F.lit("de"))).otherwise(F.col("text"))
    c = c.withColumn("said", said).where(F.col("said") != "")
    return c.select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "said")).cast("bigint").alias("n"), "said")


@register(
    "similarities",
    """WITH s AS (SELECT a.p_partkey, lower(a.p_name) AS x, lower(b.p_name) AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey - a.p_partkey % 3 + 1)
      SELECT p_partkey, round(CASE WHEN x = y THEN 1.0 ELSE 2.0 * len(list_filter(string_split(x, ''), lambda c: contains(y, c))) / (length(x) + length(y)) END, 6) AS similarity FROM s""",
)
def similarities(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    other = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("o"))
    return p.join(other, F.col("k") == F.col("p_partkey") - F.col("p_partkey") % 3 + 1).select("p_partkey", F.round(X.similarity(F.col("p_name"), F.col("o")), 6).alias("similarity"))
