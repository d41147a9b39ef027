"""Names of files and languages, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims


def lookup(table: dict[str, str]) -> Column:
    """A fixed dictionary as a map."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def found(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(lookup(table), key)


def stamp(name: Column, otherwise: Column) -> Column:
    """The time in a name (``_yyyymmddThhmmss``); ``otherwise`` where there is none, or no such time."""
    part = lambda k: F.regexp_extract(name, r"_(\d{8})T(\d{6})", k)
    text = F.concat(part(1), part(2))
    return F.coalesce(F.try_to_timestamp(F.when(text != "", text), F.lit("yyyyMMddHHmmss")), otherwise)


def bucket(time: Column) -> Column:
    """Day and month; ``0000`` without a time."""
    return F.coalesce(F.date_format(time, "ddMM"), F.lit("0000"))


def own_number(stem: Column, code: Column, day: Column) -> Column:
    """The number of a name of the form CODE_ddMMnn with this code and day, else null."""
    digits = F.regexp_extract(stem, r"^([A-Z]{2,3})_([0-9]{6,})$", 2)
    same = (F.regexp_extract(stem, r"^([A-Z]{2,3})_([0-9]{6,})$", 1) == code) & digits.startswith(day)
    return F.when(same, F.substring(digits, F.length(day) + 1, F.length(digits)).try_cast("int"))


def with_code(stem: Column, code: Column) -> Column:
    """EN_x as CODE_x.mp4; a name without a code gets one in front."""
    return F.concat(code, F.lit("_"), F.regexp_replace(stem, r"^[A-Za-z]+_(.+)$", "$1"), F.lit(".mp4"))


def folder_of(code: Column) -> Column:
    """The native folder name of a language code; Other_xx for others, Unknown for none."""
    native = found({c: n for c, n, _, _ in dims.languages()}, code)
    return F.when(F.coalesce(code, F.lit("")) == "", "Unknown").otherwise(F.coalesce(native, F.concat(F.lit("Other_"), code)))


def english_of(code: Column) -> Column:
    english = found({c: e for c, _, e, _ in dims.languages()}, code)
    return F.when(F.coalesce(code, F.lit("")) == "", "Unknown").otherwise(F.coalesce(english, F.concat(F.lit("Other_"), code)))


def code_of(folder: Column) -> Column:
    """The code for file names of a native folder, or of Other_xx; else null."""
    known = found({n: c.upper() for c, n, _, _ in dims.languages()}, folder)
    return F.coalesce(known, F.when(folder.startswith("Other_"), F.upper(F.substring(folder, F.lit(7), F.length(folder)))))


def canonical(name: Column) -> Column:
    """The native folder that an alias stands for, whatever its case; else null."""
    return found(dims.aliases(), F.lower(name))


def source_language(folder: Column, code: Column, language: Column, heard: Column) -> Column:
    """The language of a clip: by its folder, else a known code, else a short name, else what was heard."""
    known = {c for c, _, _, _ in dims.languages()}
    by_folder = found({n: c for c, n, _, _ in dims.languages()}, folder)
    short = F.lower(language)
    return F.coalesce(
        by_folder,
        F.when(F.lower(code).isin(sorted(known)), F.lower(code)),
        F.when(F.length(short).between(1, 3), short),
        F.lower(F.coalesce(heard, F.lit(""))),
    )


def signature(app: Column, batch: Column, day: Column, tool: str, extra: Column) -> Column:
    """MARKER|batch=..|brandpassed=yes|tool=..|date=..|extra; empty parts are left out."""
    name = F.when(F.trim(app) == "", "META_ADS").otherwise(F.trim(app))
    marker = F.when(F.upper(name).endswith("PROCESSED"), name).otherwise(F.concat(name, F.lit("_PROCESSED")))
    part = lambda key, c: F.when(c != "", F.concat(F.lit(key), c))
    return F.concat_ws("|", marker, part("batch=", batch), F.lit("brandpassed=yes"), F.lit(f"tool={tool}"), part("date=", day), part("", F.ltrim(extra, F.lit("|"))))


def parsed_signature(comment: Column) -> Column:
    """The parts of a signature as a map; the first one without ``=`` is the marker. Of a key that
    repeats the last part counts."""
    parts = F.transform(F.split(comment, r"\|"), lambda x, i: F.struct(F.trim(x).alias("t"), i.alias("i")))
    key = lambda p: F.when(F.contains(p["t"], F.lit("=")), F.trim(F.substring_index(p["t"], "=", 1))).when((p["i"] == 0) & (p["t"] != ""), F.lit("marker"))
    value = lambda p: F.when(F.contains(p["t"], F.lit("=")), F.trim(F.substring(p["t"], F.instr(p["t"], F.lit("=")) + 1, F.length(p["t"])))).otherwise(p["t"])
    pairs = F.filter(F.transform(parts, lambda p: F.struct(key(p).alias("key"), value(p).alias("value"))), lambda e: e["key"].isNotNull())
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def content_keys(path: Column, size: Column, time: Column, voice: Column, text: Column, body: Column) -> dict[str, Column]:
    """The three cache keys: of a file by name, size and time; of a spoken text; of a file's bytes."""
    return {
        "file_key": F.left(F.sha2(F.concat_ws("|", path, size.cast("string"), time.cast("string")), 256), F.lit(24)),
        "speech_key": F.left(F.sha2(F.concat(voice, F.lit(":"), text), 256), F.lit(16)),
        "digest": F.md5(body),
    }
