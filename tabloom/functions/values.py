"""Column functions that parse and format single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabloom.functions.fixed_values import (
    COUNTY_SLUGS,
    DECIMAL_COORDINATE,
    DEFAULT_COUNTY_SLUG,
    DMS_LEADING,
    DMS_TRAILING,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    WELL_BASE,
    WELL_NAME_TAIL,
    WELL_STATE,
)
from tabloom.functions.text import capture, slug


def score_number(text: Column) -> Column:
    """``1.2k points`` -> 1200, ``37 points`` -> 37, anything else -> 0."""
    low = F.lower(text)
    thousands = capture(low, r"([\d\.]+)\s*k").try_cast("double") * 1000
    plain = capture(low, r"(\d+)").try_cast("bigint")
    return F.when(
        low.contains("point"), F.coalesce(thousands.try_cast("bigint"), plain, F.lit(0).cast("bigint"))
    ).otherwise(F.lit(0).cast("bigint"))


def comment_number(text: Column) -> Column:
    """``1,234 comments`` -> 1234, no number -> 0."""
    digits = capture(F.replace(text, F.lit(","), F.lit("")), r"(\d+)")
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def absolute_url(url: Column, base: str) -> Column:
    """Site-relative addresses get the site in front."""
    return F.when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url)


def bare_id(fullname: Column) -> Column:
    """Listing id without its type prefix."""
    return F.replace(fullname, F.lit("t3_"), F.lit(""))


def epoch_millis_to_seconds(millis: Column) -> Column:
    """Whole seconds, rounded down."""
    return F.floor(millis.cast("double") / 1000).cast("bigint")


def epoch_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def author_line(authors: Column) -> Column:
    """First three names, ``et al.`` when there are more."""
    names = F.transform(F.slice(authors, 1, 3), lambda a: F.coalesce(a["name"], F.lit("")))
    tail = F.when(F.size(authors) > 3, " et al.").otherwise("")
    return F.concat(F.array_join(names, ", "), tail)


def file_title(filename: Column) -> Column:
    """``forum_posts.csv`` -> ``Forum Posts``."""
    stem = F.replace(filename, F.lit(".csv"), F.lit(""))
    return F.initcap(F.replace(stem, F.lit("_"), F.lit(" ")))


def shortened(text: Column, length: int = 60) -> Column:
    """At most ``length`` characters, dots where something was cut."""
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def county_slug(county: Column) -> Column:
    """Address part of a county, with the default where it is missing."""
    low = F.lower(F.btrim(county))
    rule = F.when(county.isNull() | (county == ""), DEFAULT_COUNTY_SLUG)
    for word, part in COUNTY_SLUGS.items():
        rule = rule.when(low.contains(word), part)
    return rule.otherwise(F.concat(slug(low), F.lit("-county")))


def dashed_api(api: Column) -> Column:
    """API number with dashes; eleven bare digits split 2-3-rest."""
    text = F.replace(api, F.lit(" "), F.lit("-"))
    split = F.concat_ws("-", F.substring(text, 1, 2), F.substring(text, 3, 3), F.substring(text, 6, 100))
    return F.when((F.length(text) == 11) & ~text.contains("-"), split).otherwise(text)


def well_url(api: Column, name: Column, county_part: Column, base: str = WELL_BASE) -> Column:
    """Page address of a well, NULL without a name or API number."""
    short = F.btrim(F.regexp_replace(name, WELL_NAME_TAIL, ""))
    url = F.concat(
        F.lit(f"{base}/{WELL_STATE}/"), county_part, F.lit("/wells/"), slug(short), F.lit("/"), dashed_api(api)
    )
    return F.when((api != "") & (name != ""), url)


def dms_to_decimal(degrees: Column, minutes: Column, seconds: Column, direction: Column) -> Column:
    """Degrees, minutes, seconds as signed decimal degrees, six places."""
    value = F.abs(degrees) + minutes / 60.0 + seconds / 3600.0
    return F.round(F.when(F.upper(direction).isin("S", "W"), -value).otherwise(value), 6)


def _within(value: Column, bounds: tuple[int, int]) -> Column:
    return (F.abs(value) > bounds[0]) & (F.abs(value) < bounds[1])


def _dms_matches(text: Column, pattern: str, groups: tuple[int, int, int, int]) -> Column:
    def parse(match: Column) -> Column:
        side, deg, mins, secs = (F.regexp_extract(match, pattern, g) for g in groups)
        return F.struct(
            F.upper(side).alias("side"),
            dms_to_decimal(
                deg.try_cast("double"), mins.try_cast("double"), secs.try_cast("double"), side
            ).alias("value"),
        )

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parse)


def _first(values: Column, sides: list[str], bounds: tuple[int, int]) -> Column:
    hits = F.filter(values, lambda v: v["side"].isin(sides) & _within(v["value"], bounds))
    return F.get(hits, F.lit(0))["value"]


def coordinates(text: Column) -> Column:
    """``struct<latitude, longitude>``: first plausible value of each.

    Both degree notations are tried before plain decimals. Results are
    forced to the northern and western hemisphere.
    """
    leading = _dms_matches(text, DMS_LEADING, (1, 2, 3, 4))
    trailing = _dms_matches(text, DMS_TRAILING, (4, 1, 2, 3))
    decimals = F.transform(
        F.regexp_extract_all(text, F.lit(DECIMAL_COORDINATE), F.lit(1)), lambda v: v.try_cast("double")
    )
    latitude = F.coalesce(
        _first(leading, ["N", "S"], LATITUDE_RANGE),
        _first(trailing, ["N", "S"], LATITUDE_RANGE),
        F.get(F.filter(decimals, lambda v: _within(v, LATITUDE_RANGE)), F.lit(0)),
    )
    longitude = F.coalesce(
        _first(leading, ["E", "W"], LONGITUDE_RANGE),
        _first(trailing, ["E", "W"], LONGITUDE_RANGE),
        F.get(F.filter(decimals, lambda v: _within(v, LONGITUDE_RANGE)), F.lit(0)),
    )
    return F.struct(F.abs(latitude).alias("latitude"), (-F.abs(longitude)).alias("longitude"))
