"""Verdicts on clips, renders and manifests, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def findings(*found: Column) -> Column:
    """The texts of what was found, nulls left out."""
    return F.array_compact(F.array(*found))


def padding_verdict(dark: list[Column], flat: list[Column], most: float = 8.0) -> Column:
    """Bands by their shares (top, bottom, left, right): dark ones for certain, flat ones with a question
    mark, above and below only where nothing dark was found."""
    letter, pillar = dark[0] + dark[1] > most, dark[2] + dark[3] > most
    return F.concat_ws(
        " ",
        F.when(letter, "LETTERBOX"),
        F.when(pillar, "PILLARBOX"),
        F.when((flat[0] + flat[1] > most) & ~letter & ~pillar, "flat-bands?"),
        F.when((flat[2] + flat[3] > most) & ~pillar, "blur-sides?"),
    )


def output_verdict(exists: Column, width: Column, height: Column, audio: Column, duration: Column) -> Column:
    """PASS for 1080 x 1920 with sound and more than a second."""
    fine = (width == 1080) & (height == 1920) & audio & (duration > 1)
    return F.when(~exists, "MISSING").when(F.coalesce(fine, F.lit(False)), "PASS").otherwise("FAIL")


def loudness_verdict(level: Column, peak: Column, words: Column) -> Column:
    """All warnings that apply; NO-AUDIO where nothing could be measured."""
    found = F.concat_ws(",", F.when((level < -20) | (level > -11), "LUFS-WARN"), F.when(peak > -0.3, "CLIP-WARN"), F.when(words == 0, "NO-SPEECH"))
    return F.when(level.isNull(), "NO-AUDIO").otherwise(F.coalesce(F.nullif(found, F.lit("")), F.lit("PASS")))


def output_issues(exists: Column, width: Column, height: Column, codec: Column, megabytes: Column, most: float = 500.0) -> Column:
    """What of an output differs from the canvas's rules; sides may be off by two."""
    issues = findings(
        F.when(F.abs(width - 1080) > 2, F.format_string("width %d", width)),
        F.when(F.abs(height - 1920) > 2, F.format_string("height %d", height)),
        F.when((codec != "") & ~codec.isin("h264", "avc1"), F.concat(F.lit("codec "), codec)),
        F.when(megabytes > most, F.format_string("size %.1f MB", megabytes)),
    )
    return F.when(exists, issues).otherwise(F.array(F.lit("missing")))


def render_issues(dims: Column, expected: Column, sar: Column, pix: Column, audio: Column, padding: Column, duration: Column, cut: Column, outro: float, drift: Column, tail: Column, body: Column) -> Column:
    """What is wrong with a render. Doubtful padding is none; measures that are missing find nothing."""
    return findings(
        F.when(dims != expected, F.concat(F.lit("dims "), dims)),
        F.when(sar != "1:1", F.concat(F.lit("sar "), sar)),
        F.when(pix != "yuv420p", F.concat(F.lit("pix "), pix)),
        F.when(~F.coalesce(audio, F.lit(False)), "NO AUDIO"),
        F.when((padding != "") & ~F.contains(padding, F.lit("?")), padding),
        F.when((cut > 0) & (F.abs(duration - (cut + outro)) > 0.35), "duration"),
        F.when(F.abs(drift) > 1.0, "re-levelled"),
        F.when(tail < -60, "SILENT tail"),
        F.when(body < -45, "body near-silent"),
    )


def squeezed(center: Column, left: Column, right: Column, ends: Column, least_center: float = 40.0, least: float = 0.08, most: float = 0.42, asymmetry: float = 0.5, margin: float = 0.02) -> Column:
    """Whether a sharp middle has blurred bars of like width on both sides, wider than those above and below."""
    skew = F.abs(left - right) / F.greatest(left, right, F.lit(1e-9))
    return (center >= least_center) & (left >= least) & (right >= least) & (left <= most) & (right <= most) & (skew <= asymmetry) & (F.greatest(left, right) > ends + margin)


def complete(segments: Column, targets: Column, source: Column) -> Column:
    """Whether each segment (struct with a map ``translations``) has a text in each target language but
    the source's; none without segments."""
    filled = lambda s, t: F.trim(F.coalesce(F.try_element_at(s["translations"], t), F.lit(""))) != ""
    return F.forall(targets, lambda t: (t == source) | ((F.size(segments) > 0) & F.forall(segments, lambda s: filled(s, t))))


def music_only(path: Column) -> Column:
    """Whether a part of a path begins with BGM, in any case."""
    return F.exists(F.split(path, "/"), lambda p: F.upper(p).startswith("BGM"))


def all_passed(failures: Column, heading: str = "PREFLIGHT FAIL") -> Column:
    """True, or an error that names all failures."""
    return F.when(F.size(failures) == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{heading}: "), F.array_join(failures, ", "))).cast("boolean"))


def idle(now: Column, last_activity: Column, heartbeat: Column, started: Column, finished: Column, limit: float) -> Column:
    """Whether a machine may be stopped: nothing done for longer than the limit, no fresh heartbeat, and
    not in the middle of a batch."""
    return (now - last_activity > limit) & F.coalesce(now - heartbeat >= limit, F.lit(True)) & ~(started & ~finished)


def run_out(now: Column, started: Column, heartbeat: Column, last_output: Column, cap: float, limit: float) -> Column:
    """Whether a rented machine is to be stopped: its time is up, or its heartbeat is stale and nothing came
    out for as long."""
    return (now - started >= cap) | (F.coalesce(now - heartbeat > limit, F.lit(True)) & F.coalesce(now - last_output > limit, F.lit(True)))


# What a box may be filled with.
FILLS = ["logo_rounded", "logo_square", "clean_plate", "blur"]


def box_findings(x: Column, y: Column, w: Column, h: Column, start: Column, end: Column, fill: Column, duration: Column) -> list[Column]:
    """What is wrong with a box of an edit: its fill, its place in shares of the frame, its time."""
    inside = lambda c: c.between(0, 1)
    return [
        F.when(~F.coalesce(fill.isin(FILLS), F.lit(False)), "fill"), *[F.when(~inside(c), name) for name, c in zip("xywh", (x, y, w, h), strict=True)],
        F.when((x + w > 1.001) | (y + h > 1.001), "edge"), F.when(~((start >= 0) & (start < end) & (end <= duration + 0.05)), "time"),
    ]


def aspect_finding(authored_w: Column, authored_h: Column, w: Column, h: Column) -> Column:
    """Another frame size is fine, another shape (by more than 0.01) is not: boxes are shares of the frame."""
    return F.when(F.abs(authored_w / authored_h - w / h) > 0.01, "aspect")


def seed_findings(seed: Column, start: Column, end: Column, in_cut: Column, w_px: Column, h_px: Column, least: int = 12) -> list[Column]:
    """What is wrong with a tracked box: its seed out of its time or in a cut, or a template too small to match."""
    return [F.when(~seed.between(start, end), "seed"), F.when(in_cut, "seed in a cut"), F.when((w_px < least) | (h_px < least), "small")]
