"""Loudness, speed, time and capacity estimates, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims

# Loudness targets and limits (LUFS, dB).
VOICE_TARGET, MUSIC_TARGET, SILENT_VOICE = -16.0, -16.0, -45.0
VOICE_GAIN, BED_GAIN = (-12.0, 20.0), (-40.0, 20.0)


def decibel(mean_square: Column) -> Column:
    """Level of a mean square; -240 where there are no samples."""
    return F.coalesce(20 * F.log10(F.sqrt(mean_square) + 1e-12), F.lit(-240.0))


def clamp(c: Column, limits: tuple[float, float]) -> Column:
    return F.greatest(F.lit(limits[0]), F.least(F.lit(limits[1]), c))


def mix_gains(voice: Column, bed: Column, margin: Column) -> tuple[Column, Column, Column]:
    """Gain of the voice, gain of the bed, verdict. A voice that isn't there is left alone and the
    music brought to its own target."""
    silent = voice <= SILENT_VOICE
    return (
        F.when(silent, F.lit(0.0)).otherwise(clamp(VOICE_TARGET - voice, VOICE_GAIN)),
        F.when(silent, clamp(MUSIC_TARGET - bed, BED_GAIN)).otherwise(clamp(VOICE_TARGET - margin - bed, BED_GAIN)),
        F.when(silent, "NOVOICE_FALLBACK").otherwise("MEASURED"),
    )


def guarded_bed(voice: Column, bed: Column, voice_volume: Column, bed_volume: Column, least: float = 8.0) -> Column:
    """The bed's volume, lowered by what the voice's margin lacks; as it is where either is near silence."""
    margin = (voice + 20 * F.log10(voice_volume)) - (bed + 20 * F.log10(bed_volume))
    short = (voice > -50.0) & (bed > -60.0) & (margin < least)
    return F.when(short, bed_volume / F.pow(F.lit(10.0), (least - margin) / 20)).otherwise(bed_volume)


def tempo_chain(ratio: Column) -> Column:
    """Factors of at most 2 whose product is the ratio; none where nothing is to be sped up."""
    twos = F.greatest(F.lit(0), (F.ceil(F.log2(ratio)) - 1).cast("int"))
    return F.when(ratio > 1, F.concat(F.array_repeat(F.lit(2.0), twos), F.array(F.bround(ratio / F.pow(F.lit(2.0), twos), 4)))).otherwise(F.array().cast("array<double>"))


def steps(convert_only: Column, convert: Column, dub: Column, keep_music: Column, ocr: Column, languages: Column) -> Column:
    """How many steps a job shows."""
    one = lambda c: c.cast("int")
    shared = 2 + one(convert) + one(dub & keep_music)
    return F.when(convert_only, 1).otherwise(shared + languages * (3 + one(ocr) + 2 * one(dub)))


def eta_seconds(duration: Column, convert_only: Column, convert: Column, dub: Column, keep_music: Column, ocr: Column, large_model: Column, gpu: Column, languages: Column) -> Column:
    """Expected seconds of a job, whole and not below a floor."""
    d = F.greatest(duration, F.lit(1.0))
    shared = d * 0.35 * F.when(large_model, 3.0).otherwise(1.0) + F.when(dub & keep_music, d * 0.6).otherwise(0.0) + F.when(convert, d * 0.3).otherwise(0.0)
    each = (d * 0.25 + F.when(dub, d * 0.4).otherwise(0.0)) * F.when(ocr, 1.3).otherwise(1.0)
    slow = F.when(gpu, 1.0).otherwise(6.0)
    return F.when(convert_only, F.greatest(F.lit(15), (d * 0.3 * slow).cast("int"))).otherwise(F.greatest(F.lit(30), ((shared + each * languages) * slow).cast("int")))


def limits(model: Column) -> Column:
    """A model's limits (rpm, tpm, rpd); those of the default for an unknown one."""
    as_struct = lambda v: F.struct(*[F.lit(x).alias(n) for x, n in zip(v, ("rpm", "tpm", "rpd"), strict=True)])
    out = as_struct(dims.MODEL_LIMITS[dims.DEFAULT_MODEL])
    for name, v in dims.MODEL_LIMITS.items():
        out = F.when(model == name, as_struct(v)).otherwise(out)
    return out


def spike_threshold(rpm: Column) -> Column:
    """Requests a minute from which an alert fires: nine tenths of the limit, 1 at least."""
    return F.greatest(F.lit(1), (rpm * 0.9).cast("int"))


def capacity(videos: Column, languages: Column, segments: Column, batch: Column, model: Column, margin: int = 1) -> dict[str, Column]:
    """Calls of a workload and the keys that it needs; keys are null for a model without a daily quota."""
    up = lambda a, b: F.ceil(a / b).cast("int")
    lim = limits(model)
    calls = F.greatest(F.lit(1), up(segments, batch)) * languages
    rpd = F.when(lim["rpd"] > 0, lim["rpd"])
    by_minute, by_day = F.greatest(F.lit(1), up(calls, lim["rpm"])), F.greatest(F.lit(1), up(calls * videos, rpd))
    by_day = F.when(rpd.isNotNull(), by_day)
    return {"calls_per_video": calls, "total_calls": calls * videos, "keys_for_rpm": by_minute, "keys_for_rpd": by_day, "keys": F.when(rpd.isNotNull(), F.greatest(by_minute, by_day) + margin)}


def capacity_text(videos: Column, languages: Column, segments: Column, batch: Column, model: Column) -> Column:
    """The plan in lines; null for a model without a daily quota."""
    c, lim = capacity(videos, languages, segments, batch, model), limits(model)
    # The wording.
    return F.concat_ws(
        "\n",
        F.format_string("Workload: %d videos x %d langs, ~%d segments/video, batch_size=%d", videos, languages, segments, batch),
        F.format_string("Model: %s  (free-tier per-project caps: %d RPM, %d RPD)", model, lim["rpm"], lim["rpd"]),
        F.format_string("Total calls for batch: %d", c["total_calls"]),
        F.format_string("Keys needed by RPM: ceil(%d/%d) = %d", c["calls_per_video"], lim["rpm"], c["keys_for_rpm"]),
        F.format_string("Keys needed by RPD: ceil(%d/%d) = %d", c["total_calls"], lim["rpd"], c["keys_for_rpd"]),
        F.format_string("=> Recommended: %d keys (max + 1 for retry headroom)", c["keys"]),
    )


def reset_text(utc: Column) -> Column:
    """When the quota is renewed, and how many hours that is from now: halves of a tenth, and what is less than 1e-7 hours below one, go up."""
    r = next_reset(utc)
    seconds = lambda t: F.unix_micros(t) / 1e6
    # format_number rounds the double itself, as printf of C does; format_string its shortest decimal form
    hours = F.format_number((seconds(r) - seconds(utc)) / 3600 + 1e-7, 1)
    return F.format_string("%s UTC | 00:00 PT | ~%sh", F.date_format(r, "HH:mm dd/MM/yyyy"), hours)


def pacific_hours(utc: Column) -> Column:
    """Offset of the Pacific zone: summer time from the second Sunday of March, 10:00 UTC, to the first
    Sunday of November, 9:00 UTC, in every year."""
    turn = lambda month, day, hour: F.unix_micros(F.next_day(F.make_date(F.year(utc), F.lit(month), F.lit(day)), "SU").cast("timestamp")) + hour * 3_600_000_000
    t = F.unix_micros(utc)
    return F.when((t >= turn(3, 7, 10)) & (t < turn(10, 31, 9)), -7).otherwise(-8)


def _pacific(utc: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(utc) + pacific_hours(utc) * 3_600_000_000)


def pacific_day(utc: Column) -> Column:
    return F.to_date(_pacific(utc))


def next_reset(utc: Column) -> Column:
    """The next midnight of the Pacific zone, in UTC, by the offset that holds now."""
    midnight = F.unix_micros(F.date_add(pacific_day(utc), 1).cast("timestamp"))
    return F.timestamp_micros(midnight - pacific_hours(utc) * 3_600_000_000)
