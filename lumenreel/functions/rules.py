"""Rule engines: votes, first matches, combinations, picks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import COUNTRY_REGIONS, DEFAULT_REGION, ENERGY_MUSIC, LANGUAGE_REGIONS, REGION_MUSIC, UNVOICED, VOICED

# Energy by words of an angle, in order.
ENERGY_WORDS = [
    ("tension", ["myth", "authority", "mistake", "wrong", "stop"]),
    ("uplift", ["transform", "testimonial", "diagnos", "rescue", "revive", "before"]),
    ("modern", ["feature", "demo", "rules", "showcase", "benefit"]),
]
def vote(text: Column, classes: list[tuple[str, list[str]]], default: str) -> Column:
    """The class with the most keywords in a text, in any case; the first of equals, the default for none."""
    t = F.lower(F.coalesce(text, F.lit("")))
    score = [F.struct(reduce(lambda a, b: a + b, [F.contains(t, F.lit(w)).cast("int") for w in words]).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, (name, words) in enumerate(classes)]
    best = F.greatest(*score) if len(score) > 1 else score[0]
    return F.when(best["n"] > 0, best["name"]).otherwise(F.lit(default))


def first_match(text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first rule that has a keyword in the text."""
    t, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(default)
    for name, words in reversed(rules):
        out = F.when(reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words]), F.lit(name)).otherwise(out)
    return out


def energy(angle: Column) -> Column:
    return first_match(angle, ENERGY_WORDS, "calm")


def _of(table: dict[str, str | Column], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[x if isinstance(x, Column) else F.lit(x) for kv in table.items() for x in kv]), key)


def region(language: Column) -> Column:
    return F.coalesce(_of(dict(LANGUAGE_REGIONS), F.lower(language)), F.lit(DEFAULT_REGION))


def suggestion(language: Column, angle: Column, voice: Column) -> dict[str, Column]:
    """Region, energy, cluster and the first queries for a clip's music, by its language alone."""
    r, e = region(language), energy(angle)
    queries = F.array(_of({name: seeds[0] for name, _, seeds, _ in REGION_MUSIC}, r), _of({x[0]: x[4] for x in ENERGY_MUSIC}, e))
    queries = F.when(voice, F.array_append(queries, F.lit("instrumental background"))).otherwise(queries)
    return {"region": r, "energy": e, "cluster": _of({x[0]: x[1] for x in ENERGY_MUSIC}, e), "queries": F.slice(F.array_distinct(queries), 1, 5)}


def country_region(country: Column) -> Column:
    """The region of a country's code or name, in any case; null if it isn't known."""
    return _of(dict(COUNTRY_REGIONS), F.upper(F.trim(country)))


def markets(countries: Column, regions: list[tuple[str, str]] = COUNTRY_REGIONS) -> Column:
    """(top, others): the commonest region of countries (an array of codes or names, in any case; ties by name), and the other regions in
    order. Countries that aren't known don't count; top is null if none is."""
    known = F.array_compact(F.transform(F.coalesce(countries, F.array().cast("array<string>")), lambda c: _of(dict(regions), F.upper(F.trim(c)))))
    each = F.array_sort(F.array_distinct(known))
    counted = F.transform(each, lambda r: F.struct((-F.size(F.filter(known, lambda x: x == r))).alias("n"), r.alias("r")))
    top = F.array_min(counted)["r"]
    return F.struct(top.alias("top"), F.filter(each, lambda r: r != top).alias("others"))


def music(language: Column, angle: Column, voice: Column, countries: Column) -> dict[str, Column]:
    """All of the advice on a clip's music: region (by its countries, else its language, else the default, as ``reason`` says), label, energy,
    cluster, mood, bpm, at most five different queries, and notes on the voice and the trend, markets of several regions included."""
    m, spoken, e = markets(countries), _of(dict(LANGUAGE_REGIONS), F.lower(language)), energy(angle)
    r = F.coalesce(m["top"], spoken, F.lit(DEFAULT_REGION))
    seeds = F.slice(F.array_distinct(_of({name: F.array(*map(F.lit, some)) for name, _, some, _ in REGION_MUSIC}, r)), 1, 4)
    queries = F.array_append(seeds, _of({x[0]: x[4] for x in ENERGY_MUSIC}, e))
    queries = F.when(F.coalesce(voice, F.lit(False)), F.array_append(queries, F.lit("instrumental background"))).otherwise(queries)
    others = F.when(m["top"].isNotNull() & (F.size(m["others"]) > 0), F.concat(F.lit("  (mixed markets: also "), F.array_join(m["others"], ", "), F.lit(" — pick neutral tracks.)"))).otherwise("")
    return {
        "region": r, "reason": F.when(m["top"].isNotNull(), "countries").when(spoken.isNotNull(), "language").otherwise("default"), "label": _of({x[0]: x[1] for x in REGION_MUSIC}, r),
        "energy": e, "cluster": _of({x[0]: x[1] for x in ENERGY_MUSIC}, e), "mood": _of({x[0]: x[2] for x in ENERGY_MUSIC}, e), "bpm": _of({x[0]: x[3] for x in ENERGY_MUSIC}, e),
        "queries": F.slice(F.array_distinct(queries), 1, 5), "voice_note": F.when(F.coalesce(voice, F.lit(False)), VOICED).otherwise(UNVOICED), "trend_note": F.concat(_of({x[0]: x[3] for x in REGION_MUSIC}, r), others),
    }


def outro(variant: Column, man: Column, woman: Column, other: Column) -> Column:
    """The end card for a variant; the general one where there is no variant or no card of its own."""
    v = F.lower(F.coalesce(variant, F.lit("")))
    return F.when((v == "man") & (man != ""), man).when(v.isin("woman", "women", "female") & (woman != ""), woman).otherwise(other)


def picked(pool: Column, every: Column, key: Column, seed: int) -> Column:
    """One track of a pool, or of all where the pool is empty, chosen by a digest of key and seed."""
    one = F.when(F.coalesce(F.size(pool) > 0, F.lit(False)), pool).otherwise(every)
    n = F.conv(F.left(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), F.lit(8)), 16, 10).cast("long")
    return F.get(one, F.pmod(n, F.size(one)).cast("int"))


def taxonomy(angles: Column) -> Column:
    """Lines of angles (name, description, keywords)."""
    return F.array_join(F.transform(angles, lambda a: F.concat(F.lit("- "), a["name"], F.lit(": "), a["description"], F.lit(" (keywords: "), F.array_join(a["keywords"], ", "), F.lit(")"))), "\n")


def script_language(text: Column) -> Column:
    """The language that a text's script or its accents tell."""
    return (
        F.when(text.rlike(r"\p{IsArabic}"), "ar").when(text.rlike(r"\p{IsHangul}"), "ko").when(text.rlike(r"[\p{IsHiragana}\p{IsKatakana}]"), "ja").when(text.rlike(r"\p{IsHan}"), "zh")
        .when(text.rlike(r"\p{IsThai}"), "th").when(text.rlike(r"\p{IsCyrillic}"), "ru").when(text.rlike("[đơưạảấầẩẫậắằẳẵặẹẻẽếềểễệ]"), "vi").when(text.rlike("[ñ¿¡]"), "es").when(text.rlike("[ãõ]"), "pt")
        .when(text.rlike("[äöüß]"), "de").when(text.rlike("[àâçèêëîïôùûœ]"), "fr").otherwise("en")
    )


def script_tier(duration: Column, long: Column, short: Column, least: float = 22.0) -> Column:
    """The long script from a duration on, else, and where there is none, the short one."""
    return F.when((duration >= least) & (long != ""), long).otherwise(F.coalesce(short, F.lit("")))


def script_block(scripts: Column, angle: Column, fallback: str = "care-hack") -> Column:
    """The scripts (a map by angle) for an angle, else those of the fallback; null if there are neither."""
    return F.coalesce(F.try_element_at(scripts, F.coalesce(angle, F.lit("other"))), F.try_element_at(scripts, F.lit(fallback)))


def voice(custom: Column, default: Column) -> Column:
    """The voice asked for, else the language's; an error where there is neither."""
    return F.when(custom != "", custom).when(default.isNotNull(), default).otherwise(F.raise_error(F.lit("no voice for this language")))


def beam_size(model: Column) -> Column:
    return F.when(model.isin("tiny", "base"), 1).otherwise(5)


def fatigue(*triggers: Column) -> Column:
    """Whether two of the triggers hold."""
    return reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(False)).cast("int") for t in triggers]) >= 2
