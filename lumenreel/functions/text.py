"""Scalar functions on text and media values, as Column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def srt_time(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; milliseconds rounded half to even."""
    ms = F.bround(seconds * 1000).cast("bigint")
    part = lambda x, n: F.lpad(x.cast("string"), n, "0")
    hours = F.floor(ms / 3_600_000).cast("bigint")
    text = F.when(hours < 100, part(hours, 2)).otherwise(hours.cast("string"))
    return F.concat(text, F.lit(":"), part(F.floor(ms / 60_000).cast("bigint") % 60, 2), F.lit(":"), part(F.floor(ms / 1000).cast("bigint") % 60, 2), F.lit(","), part(ms % 1000, 3))


def slug(text: Column) -> Column:
    """Without other signs than word characters, blanks, hyphens and slashes; then ``/`` and blanks as ``_``."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\s\-/]", ""), "[/ ]", "_")


def compact(text: Column, limit: int) -> Column:
    """White space collapsed; longer texts cut to ``limit - 3`` characters and ``...``."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 3), F.lit("..."))).otherwise(t)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)[\w']+"))


def masked(key: Column) -> Column:
    """The last six characters after ``...``."""
    return F.concat(F.lit("..."), F.right(key, F.lit(6)))


def tokens(text: Column) -> Column:
    """A comma list as trimmed, non-empty, distinct items in order."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))


def blank(text: Column) -> Column:
    """Missing in the sense of the manifests: null or nothing but blanks."""
    return F.coalesce(F.trim(text), F.lit("")) == ""


def tags(comment: Column) -> Column:
    """``marker|k=v|...`` as a map; the marker's value is null."""
    return F.str_to_map(comment, F.lit(r"\|"), F.lit("="))


def similarity(a: Column, b: Column) -> Column:
    """2 * characters of a that b holds, over both lengths; lower-cased; 1 if equal."""
    x, y = F.lower(a), F.lower(b)
    hits = F.size(F.filter(F.split(x, ""), lambda c: (c != "") & F.contains(y, c)))
    return F.when(x == y, F.lit(1.0)).otherwise(2.0 * hits / (F.length(x) + F.length(y)))


def two_lines(text: Column, limit: int = 42) -> Column:
    """Texts longer than ``limit`` are broken near the middle: at the sum of the lengths of the first
    words, a blank counted for each, that lies nearest to it, the earliest of equals; 0 is a candidate,
    so a first word far beyond the middle leaves the first line empty."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    mid = F.floor(F.length(text) / 2).cast("int")
    best = F.aggregate(
        words,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at")),
        lambda acc, w: F.struct(
            (acc["sum"] + F.length(w) + 1).alias("sum"),
            F.when(F.abs(acc["sum"] + F.length(w) + 1 - mid) < F.abs(acc["at"] - mid), acc["sum"] + F.length(w) + 1).otherwise(acc["at"]).alias("at"),
        ),
    )["at"]
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    broken = F.concat(bare(F.substring(text, F.lit(1), best)), F.lit("\n"), bare(F.substring(text, best + 1, F.length(text))))
    return F.when(F.length(text) <= limit, text).otherwise(broken)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes [x1, y1, x2, y2]; 0 without a union."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    area = lambda z: F.greatest(F.lit(0.0), z[2] - z[0]) * F.greatest(F.lit(0.0), z[3] - z[1])
    both = side(0, 2) * side(1, 3)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def aspect_class(width: Column, height: Column) -> Column:
    """OK near 9:16, taller, or WIDE; the ratio is rounded to three places first."""
    r = F.round(width / height, 3)
    return F.when(F.abs(r - 0.5625) <= 0.02, "OK").when(r < 0.5625, "taller").otherwise("WIDE")


def json_strings(reply: Column) -> Column:
    """A model's reply as an array of strings: fences removed, else the widest bracketed part; null if
    neither is a JSON array. Items that aren't strings become text: None, True and False for null and
    booleans, JSON for all others."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```(?:json)?\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(bare, r"(?s)\[.*\]", 0)

    def text(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        as_text = F.variant_get(v, "$", "string")
        return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(as_text)).when(kind == "STRING", as_text).otherwise(F.to_json(v))

    def listed(c: Column) -> Column:
        v = F.try_parse_json(c)
        return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.transform(F.try_variant_get(v, "$", "array<variant>"), text))

    return F.coalesce(listed(bare), listed(F.when(inner != "", inner)))


def template(text: Column, app: Column, cta: Column, tagline: Column) -> Column:
    """``{app}``, ``{cta}`` and ``{tagline}`` filled in, with defaults for nulls."""
    out = F.replace(text, F.lit("{app}"), F.coalesce(app, F.lit("the app")))
    out = F.replace(out, F.lit("{cta}"), F.coalesce(cta, F.lit("Download now")))
    return F.replace(out, F.lit("{tagline}"), F.coalesce(tagline, F.lit("")))


def composed(text: Column) -> Column:
    """Unicode's composed form (NFC); texts in ASCII are left alone. Spark has no function for it."""

    @F.pandas_udf("string")
    def nfc(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.when(text.rlike(r"[^\x00-\x7F]"), nfc(text)).otherwise(text)


def drawtext(text: Column) -> Column:
    """Escaped for a drawing filter: backslashes first, then quotes, colons and per cents."""
    out = F.replace(composed(text), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(F.replace(out, F.lit("'"), F.lit("\u2019")), F.lit(":"), F.lit("\\:"))
    return F.replace(out, F.lit("%"), F.lit("%%"))


def retry_seconds(error: Column, default: int = 5) -> Column:
    """The delay that an error text asks for, 1 at least; by its field, else by its words."""
    field = F.regexp_extract(error, r"retryDelay\\?\"?\s*[:=]\s*\\?\"?(\d+)s", 1)
    words = F.regexp_extract(error, r"(?i)retry(?:ing)?\s+in\s+(\d+)s", 1)
    number = lambda c: F.greatest(F.lit(1), F.when(c != "", c).cast("int"))
    return F.when(field != "", number(field)).when(words != "", number(words)).otherwise(F.lit(default))


# What a message of a used-up limit holds, in this case.
LIMIT_WORDS = ["429", "RESOURCE_EXHAUSTED", "rate_limit", "too many requests", "quota", "rate limit"]


def rate_limited(error: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(error, F.lit(w)) for w in LIMIT_WORDS])


def truthy(text: Column) -> Column:
    """Whether a setting is on."""
    return F.lower(F.trim(text)).isin("1", "true", "yes", "on")


def number_or(text: Column, kind: str, default: Column) -> Column:
    """A setting as a number; the default if it is missing or isn't one."""
    return F.coalesce(F.trim(text).try_cast(kind), default)


def header_line(text: Column, language: Column) -> Column:
    """The first ``Language:`` line replaced, up to the end of what it says; if there is none, put in front."""
    line = F.concat(F.lit("Language: "), language)
    around = lambda k: F.regexp_extract(text, r"(?s)\A((?:.*?\n)??)Language:\s*[^\n]*(.*)\z", k)
    return F.when(text.rlike("(?m)^Language:"), F.concat(around(1), line, around(2))).otherwise(F.concat(line, F.lit("\n"), text))


def coverage(text: Column, supported: Column) -> Column:
    """Share of the distinct characters beyond ASCII that are in the array ``supported``; 1 if there are none."""
    seen = F.array_distinct(F.filter(F.split(text, ""), lambda c: c.rlike(r"[^\x00-\x7F]")))
    return F.when(F.size(seen) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(seen, supported)) / F.size(seen))


def cjk(text: Column) -> Column:
    """Whether a text has Chinese, Japanese or Korean characters."""
    return text.rlike("[\u4e00-\u9fff\u3040-\u309f\u30a0-\u30ff\uac00-\ud7af]")


def wrapped(text: Column, width: Column, each: Column) -> Column:
    """Lines of at most ``width``, where a character takes ``each``: at words, or at characters in
    texts without blanks between words; a longer word has a line of its own."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    start = F.array().cast("array<string>")

    def fill(parts: Column, gap: str) -> Column:
        def step(lines: Column, part: Column) -> Column:
            last = F.element_at(lines, -1)
            longer = F.concat(last, F.lit(gap), part)
            return F.when(F.size(lines) == 0, F.array(part)).when(F.length(longer) * each > width, F.array_append(lines, part)).otherwise(F.array_append(F.slice(lines, F.lit(1), F.size(lines) - 1), longer))

        return F.aggregate(parts, start, step)

    lines = F.when(cjk(text), fill(F.filter(F.split(text, ""), lambda c: c != ""), "")).otherwise(fill(words, " "))
    return F.when(F.size(lines) == 0, F.array(F.lit(""))).otherwise(lines)


def line_count(lengths: Column, gap: Column, width: Column, each: Column) -> Column:
    """The number of lines that wrapped() makes of parts of these lengths, ``gap`` characters between two."""

    def step(acc: Column, n: Column) -> Column:
        longer = acc["wide"] + gap + n
        fresh = (acc["lines"] == 0) | (longer * each > width)
        return F.struct((acc["lines"] + F.when(fresh, 1).otherwise(0)).alias("lines"), F.when(fresh, n).otherwise(longer).alias("wide"))

    return F.aggregate(lengths, F.struct(F.lit(0).alias("lines"), F.lit(0).alias("wide")), step, lambda acc: F.greatest(acc["lines"], F.lit(1)))


def largest_size(text: Column, width: Column, height: Column, least: int, most: int, share: float = 0.55) -> Column:
    """The largest font size whose wrapped lines fit; ``least`` if none does. A character is ``share``
    of the size wide, and a line the size and four high. Larger letters never make fewer lines, so sizes are halved; only lengths are counted."""
    part = lambda c: F.transform(F.filter(c, lambda w: w != ""), lambda w: F.length(w))
    parts = F.when(cjk(text), F.struct(part(F.split(text, "")).alias("n"), F.lit(0).alias("gap"))).otherwise(F.struct(part(F.split(text, r"\s+")).alias("n"), F.lit(1).alias("gap")))

    def halved(of: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            z = F.shiftright(acc["lo"] + acc["hi"] + 1, 1)
            fits = F.coalesce(line_count(of["n"], of["gap"], width, z * share) * (z + 4) <= height, F.lit(False))
            return F.when(acc["lo"] == acc["hi"], acc).when(fits, F.struct(z.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), (z - 1).alias("hi")))

        steps = F.sequence(F.lit(1), F.lit((most - least + 1).bit_length()))
        return F.aggregate(steps, F.struct(F.lit(least - 1).alias("lo"), F.lit(most).alias("hi")), step, lambda acc: F.greatest(acc["lo"], F.lit(least)))

    # parts are worked out once a text
    return F.transform(F.array(parts), halved)[0]


def nested_lists(spec: Column) -> Column:
    """``1:5,26;13:23`` as a map of an id to its numbers; parts without a colon are skipped."""
    parts = F.filter(F.split(spec, ";"), lambda p: F.contains(p, F.lit(":")))
    numbers = lambda p: F.transform(F.filter(F.split(F.substring(p, F.instr(p, F.lit(":")) + 1, F.length(p)), ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).cast("double"))
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("id"), numbers(p).alias("at"))))


def stepped(first: Column, last: Column, step: float) -> Column:
    """Times from ``first`` to ``last``, both included, to two places."""
    n = F.floor((last - first) / step + 1e-6).cast("int")
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.bround(first + i * step, 2))).otherwise(F.array().cast("array<double>"))


def prompt(source: Column, target: Column, texts: Column, before: Column, after: Column) -> Column:
    """The request for a batch of texts: numbered lines, with the context's own ones around them."""
    # The wording.
    lines = lambda a, form: F.array_join(F.transform(a, lambda x, i: F.format_string(form, i + 1, x)), "\n")
    part = lambda head, a, form: F.when(F.size(a) > 0, F.concat(F.lit(f"\n{head}\n"), lines(a, form)))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Translate the following subtitle segments from "), source, F.lit(" to "), target, F.lit(".")),
        F.lit("Return ONLY a JSON array of translated strings, matching the input order."),
        part("Context (previous segments, do NOT translate these):", before, '  [%d] "%s"'),
        F.concat(F.lit("\nSegments to translate:\n"), lines(texts, '  %d. "%s"')),
        part("Context (following segments, do NOT translate these):", after, '  [%d] "%s"'),
    )
