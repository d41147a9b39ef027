"""Boxes, canvases and filter strings, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH, HEIGHT = 1080, 1920


def _channel(color: Column, k: int) -> Column:
    """The k-th byte of #rrggbb."""
    return F.conv(F.substring(color, 2 + 2 * k, 2), 16, 10).cast("int")


def quantized(color: Column, step: int = 32) -> Column:
    """#RRGGBB with each channel lowered to a multiple of ``step``."""
    low = lambda k: F.lpad(F.hex((F.floor(_channel(color, k) / step) * step).cast("int")), 2, "0")
    return F.concat(F.lit("#"), low(0), low(1), low(2))


def rgba(color: Column, alpha: Column) -> Column:
    """[r, g, b, a]; white where it isn't six digits."""
    bare = F.concat(F.lit("#"), F.ltrim(color, F.lit("#")))
    return F.when(F.length(bare) == 7, F.array(_channel(bare, 0), _channel(bare, 1), _channel(bare, 2), alpha)).otherwise(F.array(F.lit(255), F.lit(255), F.lit(255), alpha))


def pixels(x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> list[Column]:
    """A normalised box in whole pixels inside the frame: rounded half to even, at least one wide and high."""
    whole = lambda c: F.bround(c).cast("int")
    px = F.greatest(F.lit(0), F.least(F.lit(width - 1), whole(x * width)))
    py = F.greatest(F.lit(0), F.least(F.lit(height - 1), whole(y * height)))
    return [px, py, F.greatest(F.lit(1), F.least(width - px, whole(w * width))), F.greatest(F.lit(1), F.least(height - py, whole(h * height)))]


def padded(x: Column, y: Column, w: Column, h: Column, share: float) -> list[Column]:
    """A normalised box grown by a share of its size on every side, inside the frame."""
    px, py = F.greatest(F.lit(0.0), x - w * share), F.greatest(F.lit(0.0), y - h * share)
    return [px, py, F.least(1.0 - px, w + 2 * w * share), F.least(1.0 - py, h + 2 * h * share)]


def _even(c: Column) -> Column:
    return c - c % 2


def fitted(w: Column, h: Column, width: int = WIDTH, height: int = HEIGHT) -> list[Column]:
    """Width, height and offsets of a picture that fills a canvas as far as it fits: the whole canvas
    within 2 % of its ratio, else the long side, with even sizes."""
    ratio, target = w / h, width / height
    wide = ratio > target
    fw = _even(F.when(wide, F.lit(width)).otherwise(F.bround(height * ratio).cast("int")))
    fh = _even(F.when(wide, F.bround(width / ratio).cast("int")).otherwise(F.lit(height)))
    near = F.abs(ratio - target) / target < 0.02
    half = lambda c: F.floor(c / 2).cast("int")
    return [F.when(near, F.lit(width)).otherwise(fw), F.when(near, F.lit(height)).otherwise(fh), F.when(near, F.lit(0)).otherwise(half(width - fw)), F.when(near, F.lit(0)).otherwise(half(height - fh))]


def displayed(w: Column, h: Column, sar: Column, rotation: Column) -> tuple[Column, Column]:
    """Size as shown: sides and pixel ratio swapped by a quarter turn; a ratio that is missing, malformed
    or not positive is 1:1."""
    n, d = (F.split(sar, ":")[k].try_cast("int") for k in (0, 1))
    good = sar.rlike("^[0-9]+:[0-9]+$") & (n > 0) & (d > 0)
    n, d = F.when(good, n).otherwise(F.lit(1)), F.when(good, d).otherwise(F.lit(1))
    turned = F.pmod(rotation, F.lit(360)).isin(90, 270)
    dw = F.when(turned, F.floor(h * d / n)).otherwise(F.floor(w * n / d)).cast("int")
    return dw, F.when(turned, w).otherwise(h)


def even_displayed(w: Column, h: Column, sar: Column, rotation: Column) -> tuple[Column, Column]:
    """The size as shown in even numbers, two at least."""
    down = lambda c: F.greatest(F.lit(2), c - c % 2)
    dw, dh = displayed(w, h, sar, rotation)
    return down(dw), down(dh)


def is_portrait(w: Column, h: Column, tolerance: float = 0.05) -> Column:
    """9:16 within a share of it."""
    return F.abs(w / h - 9 / 16) <= tolerance * (9 / 16)


def is_target(w: Column, h: Column, tolerance: float = 0.05) -> Column:
    """The canvas's ratio within an absolute difference."""
    return F.abs(w / h - WIDTH / HEIGHT) <= tolerance


def bands(w: Column, h: Column) -> list[Column]:
    """A picture fitted into the canvas: width, height, and the bands above, below and beside it."""
    scale = F.least(WIDTH / w, HEIGHT / h)
    dw, dh = _even((w * scale).cast("int")), _even((h * scale).cast("int"))
    half = lambda c: F.floor(c / 2).cast("int")
    top = half(HEIGHT - dh)
    return [dw, dh, top, HEIGHT - dh - top, half(WIDTH - dw)]


def font_size(box_w: Column, box_h: Column, text: Column, share: float = 0.55, least: int = 14) -> Column:
    """Three quarters of the box's height, or what its width leaves room for; ``least`` at least."""
    size = F.greatest(F.lit(least), (box_h * 0.75).cast("int"))
    n = F.length(text)
    return F.when((n > 0) & (n * size * share > box_w), F.greatest(F.lit(least), (box_w / (n * share)).cast("int"))).otherwise(size)


def sample_times(duration: Column, shares: list[float], least: float = 0.5) -> Column:
    """Times at shares of a duration, not before ``least``."""
    return F.array(*[F.greatest(F.lit(least), duration * s) for s in shares])


def even_times(duration: Column, n: int, lo: float = 0.05, span: float = 0.9) -> Column:
    """``n`` times spread evenly from ``lo`` of a duration over ``span`` of it."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: duration * (lo + span * i / max(1, n - 1)))


def tail_times(duration: Column, n: int, tail: float = 7.0, end: float = 0.06) -> Column:
    """``n`` times spread evenly over a clip's last ``tail`` seconds, up to just before its end."""
    start = F.greatest(F.lit(0.0), duration - tail)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + (duration - end - start) * i / (n - 1))


def cover_filter(box: Column, background: Column, opacity: Column, start: Column, end: Column, pad: int = 4) -> Column:
    """The filter that covers a text's box [x1, y1, x2, y2] for a while."""
    return F.format_string(
        f"drawbox=x=%d:y=%d:w=%d:h=%d:color=%s@%.2f:t=fill:enable='between(t,%.2f,%.2f)'",
        box[0] - pad, box[1] - pad, box[2] - box[0] + 2 * pad, box[3] - box[1] + 2 * pad, F.replace(background, F.lit("#"), F.lit("0x")), opacity, start, end,
    )


def text_filter(box: Column, escaped: Column, size: Column, color: Column, start: Column, end: Column, font: str) -> Column:
    """The filter that draws a text in the middle of its box."""
    w, h = box[2] - box[0], box[3] - box[1]
    return F.format_string(
        f"drawtext=text='%s':fontfile={font}:x=%d+(%d-text_w)/2:y=%d+(%d-text_h)/2:fontsize=%d:fontcolor=%s:enable='between(t,%.2f,%.2f)'",
        escaped, box[0], w, box[1], h, size, F.replace(color, F.lit("#"), F.lit("0x")), start, end,
    )


def canvas_filter(w: Column, h: Column, mode: Column, width: int = WIDTH, height: int = HEIGHT) -> Column:
    """The filter chain that brings a picture onto the canvas."""
    fw, fh, x, y = fitted(w, h, width, height)
    near = F.abs(w / h - width / height) / (width / height) < 0.02
    crop = f"[0:v]scale={width}:{height}:force_original_aspect_ratio=increase,crop={width}:{height}"
    blur = F.format_string(f"{crop},boxblur=20:5[bg];[0:v]scale=%d:%d[fg];[bg][fg]overlay=%d:%d[vout]", fw, fh, x, y)
    return F.when(near, F.lit(f"[0:v]scale={width}:{height}[vout]")).when(mode == "cover", F.lit(f"{crop}[vout]")).otherwise(blur)
