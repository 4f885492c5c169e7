"""Scalar expressions."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_bin(value: str | Column, origin: float, width: float) -> Column:
    """Lower edge of the bin that a value falls in; bins go on below the origin."""
    c = F.col(value) if isinstance(value, str) else value
    return (origin + F.floor((c - origin) / width) * width).cast("long")


def round_half_even(value: Column) -> Column:
    return F.rint(value).cast("long")


def composite_key(*columns: str) -> Column:
    """Columns joined by underscores; a missing value is the stratum ``nan``."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])


def run_tag(name: Column) -> Column:
    """Lower-case words and digits with hyphens between; null if nothing is left."""
    slug = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(slug != "", slug)


def slide_stem(path: Column) -> Column:
    """File name without its suffix, and without ``.ome`` before a TIFF suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)([.]ome(?=[.]tiff?$))?[.][^.]*$", "")


def duration(seconds: Column) -> Column:
    """Seconds as HH:MM:SS; hours may have more digits."""
    s = F.floor(seconds).cast("long")
    two = lambda n: F.when(n < 10, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string"))
    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor(s % 3600 / 60)), two(s % 60))


def split_flags(text: Column) -> Column:
    """Trimmed, non-empty items of a comma list."""
    return F.filter(F.transform(F.split(text, ","), F.trim), lambda x: x != "")


@functools.singledispatch
def hive_value(value: object) -> str:
    """A partition value in its one spelling, from which equal values alone come out equal."""
    return str(value)


@hive_value.register
def _(value: bool) -> str:
    return "true" if value else "false"


@hive_value.register
def _(value: float) -> str:
    """The shortest decimal that reads back as the number, without an exponent."""
    if not math.isfinite(value):
        raise ValueError(f"{value} can't name a partition")
    whole, _, part = format(Decimal(repr(value)), "f").partition(".")
    part = part.rstrip("0")
    return f"{whole}.{part}" if part else str(int(whole))


@hive_value.register(list)
@hive_value.register(tuple)
def _(value: list | tuple) -> str:
    return "+".join(map(hive_value, value))


def hive_path(values: Mapping[str, object]) -> str:
    """Sorted ``key=value`` folders; keys without a value are left out."""
    return "/".join(f"{k}={hive_value(v)}" for k, v in sorted(values.items()) if v is not None)


def hive_parse(name: Column) -> Column:
    """Map of the ``key=value`` folders of a path; the other parts of it are left out."""
    parts = F.filter(F.split(name, "/"), lambda x: x.contains("="))
    return F.map_from_entries(F.transform(parts, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_extract(x, "=(.*)$", 1).alias("v"))))


def template_path(template: str, values: Mapping[str, Column], optional: Sequence[str] = (), extra: Mapping[str, Column] | None = None) -> Column:
    """A path for each row: ``{key}`` gives way to the row's value, and a folder that needs an
    optional key whose value is null goes. ``extra`` folders, sorted, stand before the file name."""
    folders, file = template.split("/")[:-1], template.split("/")[-1]
    wanted = set(re.findall(r"{(\w+)}", template))
    if wanted - set(values):
        raise KeyError(f"no value for {sorted(wanted - set(values))}")

    def filled(text: str) -> Column:
        pieces = re.split(r"{(\w+)}", text)
        return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces)])

    parts = []
    for folder in folders:
        keys = re.findall(r"{(\w+)}", folder)
        own = filled(folder)
        must = [k for k in keys if k not in optional]
        parts.append(F.coalesce(own, F.raise_error(F.lit(f"no value for {must}")).cast("string")) if must else own)
    parts += [F.concat(F.lit(f"{k}="), c.cast("string")) for k, c in sorted((extra or {}).items())]
    return F.concat_ws("/", *parts, filled(file))


def run_id(when: Column) -> Column:
    """UTC time as an id that sorts by time."""
    return F.date_format(when, "yyyyMMdd'T'HHmmss'Z'")


def draw(seed: int, *columns: str) -> Column:
    """A digest of a row's keys and a seed, by which rows are drawn and ordered at random but alike on every run."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def uniform(digest: Column) -> Column:
    """A digest as a number from 0 up to 1: its first 52 bits."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(1 << 52)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def window_clamp(centre: Column, size: int, extent: Column) -> tuple[Column, Column, Column]:
    """Start and stop of a window cut to the image, and the offset of the cut inside the window."""
    start = round_half_even(centre) - size // 2
    low = F.greatest(start, F.lit(0))
    high = F.greatest(F.least(start + size, extent), low)
    return low, high, low - start


def softmax(columns: Sequence[Column], temperature: float) -> list[Column]:
    """Shifted softmax over columns of a row."""
    top = F.greatest(*columns) if len(columns) > 1 else columns[0]
    powers = [F.exp((c - top) / temperature) for c in columns]
    total = sum(powers[1:], powers[0])
    return [p / total for p in powers]
