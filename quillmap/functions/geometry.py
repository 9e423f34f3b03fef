"""Boxes as four integer columns on a page of 1000 by 1000."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmap.functions.text import token_count

MIN_SIDE, CHAR_WIDTH, CHAR_HEIGHT = 5, 8, 12


def scale(v: Column, extent: Column) -> Column:
    """A raw coordinate on the page of 1000, truncated and clamped."""
    return F.least(F.lit(1000), F.greatest(F.lit(0), (v / extent * 1000).cast("int")))


def band(v: Column, height: int) -> Column:
    """Floor to a multiple of the height, negative values too."""
    return (F.floor(v / height) * height).cast("int")


def is_valid(x0, y0, x1, y1) -> Column:
    """Not null, not all zero, sides of at least 5, within the page."""
    given = x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
    zero = (x0 == 0) & (y0 == 0) & (x1 == 0) & (y1 == 0)
    inside = (F.least(x0, y0, x1, y1) >= 0) & (F.greatest(x0, y0, x1, y1) <= 1000)
    return F.coalesce(given & ~zero & (x1 - x0 >= MIN_SIDE) & (y1 - y0 >= MIN_SIDE) & inside, F.lit(False))


def is_small(text, x0, y0, x1, y1) -> Column:
    """Less than half as wide or high as its text suggests; false without text or box."""
    narrow = (x1 - x0 < 0.5 * F.length(text) * CHAR_WIDTH) | (y1 - y0 < 0.5 * CHAR_HEIGHT)
    return F.coalesce((F.length(text) > 0) & narrow, F.lit(False))


def expand(text, x0, y0, x1, y1) -> list[Column]:
    """Grown from the centre towards the size that the text suggests; without text as it was."""
    width = F.greatest(F.length(text) * CHAR_WIDTH, F.lit(MIN_SIDE))
    dx, dy = F.floor((width - (x1 - x0)) / 2).cast("int"), F.floor((CHAR_HEIGHT - (y1 - y0)) / 2).cast("int")
    some = F.coalesce(F.length(text) > 0, F.lit(False))
    wide, high = some & (x1 - x0 < width), some & (y1 - y0 < CHAR_HEIGHT)
    return [F.when(wide, F.greatest(F.lit(0), x0 - dx)).otherwise(x0), F.when(high, F.greatest(F.lit(0), y0 - dy)).otherwise(y0), F.when(wide, F.least(F.lit(1000), x1 + dx)).otherwise(x1), F.when(high, F.least(F.lit(1000), y1 + dy)).otherwise(y1)]


def fix(text, x0, y0, x1, y1) -> list[Column]:
    """A small box expands; another gets a least side to the right and bottom."""
    small, grown = is_small(text, x0, y0, x1, y1), expand(text, x0, y0, x1, y1)
    right = F.when(x1 - x0 < MIN_SIDE, F.least(F.lit(1000), x0 + MIN_SIDE)).otherwise(x1)
    bottom = F.when(y1 - y0 < MIN_SIDE, F.least(F.lit(1000), y0 + MIN_SIDE)).otherwise(y1)
    return [F.when(small, g).otherwise(o) for g, o in zip(grown, (x0, y0, right, bottom), strict=True)]


def distance(a: list, b: list) -> Column:
    """Between the centres of two boxes."""
    dx = (a[0] + a[2]) / 2 - (b[0] + b[2]) / 2
    dy = (a[1] + a[3]) / 2 - (b[1] + b[3]) / 2
    return F.sqrt(dx * dx + dy * dy)


def words_consistent(text, words, x0, x1) -> Column:
    """As many words as the text has tokens, together at most 1.5 times as wide; true without text or words."""
    total = F.aggregate(words, F.lit(0), lambda acc, w: acc + F.element_at(w["box"], 3) - F.element_at(w["box"], 1))
    none = text.isNull() | (text == "") | words.isNull() | (F.size(words) == 0)
    return F.when(none, F.lit(True)).otherwise((token_count(text) == F.size(words)) & (total <= (x1 - x0) * 1.5))


def split_words(text, x0, y0, x1, y1, least_width: int = 0, least_gap: int = 0) -> Column:
    """array<struct<text, box>>: the box dealt to the words by their lengths, in order.

    A single word keeps the whole box; the right edge stops at the box's. The second
    version has a least width of 5 and a least gap of 2.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    width = lambda w: F.greatest((F.length(w) / F.length(text) * (x1 - x0)).cast("int"), F.lit(least_width))
    gap = F.greatest(((x1 - x0) * 0.02).cast("int"), F.lit(least_gap))

    def place(w: Column, i: Column) -> Column:
        left = F.aggregate(F.slice(words, 1, i), x0, lambda acc, v: acc + width(v) + gap)
        return F.struct(w.alias("text"), F.array(left, y0, F.least(left + width(w), x1), y1).alias("box"))

    return F.when(F.size(words) == 1, F.array(F.struct(F.element_at(words, 1).alias("text"), F.array(x0, y0, x1, y1).alias("box")))).otherwise(F.transform(words, place))


def polygon_to_rect(points: Column) -> list[Column]:
    """Least and greatest coordinates of an array of [x, y]."""
    xs, ys = F.transform(points, lambda p: F.element_at(p, 1)), F.transform(points, lambda p: F.element_at(p, 2))
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def xywh_to_xyxy(box: Column) -> Column:
    """[x, y, w, h] as corners; null unless it has four parts."""
    at = lambda i: F.element_at(box, i)
    return F.when(F.size(box) == 4, F.array(at(1), at(2), at(1) + at(3), at(2) + at(4)))
