"""Cleaning, key building and other scalar functions as native Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Time formats of photo tables, tried in this order; months, days and hours may have one digit.
CAPTURE_FORMATS = ("yyyy/M/d H:m:s", "yyyy/M/d H:m", "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy/M/d", "yyyy-M-d")
#: Fixed value: the time format in the headers of image files.
EXIF_FORMATS = ("yyyy:MM:dd HH:mm:ss",)

#: How persistent identifiers are written: prefix, region, type, temporal part, serial of seven digits at least.
PID_FORMAT, PID_PREFIX = "%s:%s:%s-%s-%07d", "kg"


def clean(c: Column, null_tokens: tuple[str, ...] = ("nan", "none")) -> Column:
    """Trimmed text; null where it is empty or one of the null tokens."""
    t = F.trim(c.cast("string"))
    return F.when((t != "") & ~F.lower(t).isin(*null_tokens), t)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[clean(c) for c in columns])


def if_different(value: Column, name: Column) -> Column:
    """A child attribute, only where it differs from the chosen name."""
    return F.when(~value.eqNullSafe(name), value)


def composite_key(*columns: Column, separator: str = "|") -> Column:
    """Cleaned parts joined; separators at the ends go, inner empty parts stay; null if all are empty."""
    joined = F.concat_ws(separator, *[F.coalesce(clean(c), F.lit("")) for c in columns])
    stripped = F.btrim(joined, F.lit(separator))
    return F.when(stripped != "", stripped)


def ref_type_of(key: Column) -> Column:
    """Entity type guessed from a natural key."""
    low = F.lower(key)
    marks = ("pl", "clu", "ac", "doc", "img")
    return reduce(lambda e, m: e.when(low.contains(f"-{m}-"), m), marks[1:], F.when(low.contains("-pl-"), "pl")).otherwise("pl")


def valid_region(c: Column) -> Column:
    return c.rlike("^[a-z][a-z0-9_]*$")


def valid_type(c: Column) -> Column:
    return c.rlike("^[a-z]{2,4}$")


def pid(region: Column, kind: Column, temporal: Column, serial: Column, prefix: str = PID_PREFIX) -> Column:
    """Persistent identifier; seven digits are the least width, longer serials keep all theirs."""
    when = F.coalesce(F.nullif(F.trim(temporal), F.lit("")), F.lit("unk"))
    return F.format_string(PID_FORMAT, F.lit(prefix), region, kind, when, serial.cast("long"))


def capture_time(c: Column, formats: tuple[str, ...] = CAPTURE_FORMATS) -> Column:
    """Timestamp by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats])


def dms_to_decimal(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    value = degrees + minutes / 60.0 + seconds / 3600.0
    return F.when(F.upper(hemisphere).isin("S", "W"), -value).otherwise(value)


def normal_header(c: Column) -> Column:
    """A column header with standard-vocabulary codes and parentheses as blanks, blanks collapsed, lower case; what stands
    in parentheses stays."""
    x = F.regexp_replace(F.regexp_replace(c, r"[EeＥ]\d+|[Pp]\d+", " "), "[（()）]", " ")
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, zero where whole is zero."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


#: Fields of a statement value. Each is read as text, whatever its JSON type.
VALUE_FIELDS = ("value", "wkt", "srid", "ref_natural_key", "ref_type_abbr", "ref_region", "iso", "confidence")


def value_parts(value: Column) -> Column:
    """The fields of a statement value as one struct, so that its JSON is parsed once; all null where it is no JSON object."""
    whole = F.when(F.ltrim(value).startswith("{"), value)
    return F.from_json(whole, ", ".join(f"{f} string" for f in VALUE_FIELDS))


def kind_of_parts(parts: Column) -> Column:
    """Shape of a statement value: geometry, ref, text, time or json."""
    has = lambda k: parts[k].isNotNull()
    return F.when(has("wkt"), "geometry").when(has("ref_natural_key"), "ref").when(has("value"), "text").when(has("iso"), "time").otherwise("json")


def literal_of_parts(parts: Column, value: Column) -> Column:
    """Text of a literal value; null for references and geometries; other shapes keep their JSON text."""
    kind = kind_of_parts(parts)
    return F.when(kind == "text", parts["value"]).when(kind == "time", parts["iso"]).when(kind == "json", value)


def confidence_of_parts(parts: Column) -> Column:
    """Confidence of a statement, 1 where absent or empty, null where it is not a number."""
    raw = F.trim(F.coalesce(parts["confidence"], F.lit("")))
    return F.when(raw == "", 1.0).otherwise(raw.try_cast("double"))


def json_kind(value: Column) -> Column:
    return kind_of_parts(value_parts(value))


def literal_of(value: Column) -> Column:
    return literal_of_parts(value_parts(value), value)


def confidence_of(value: Column) -> Column:
    return confidence_of_parts(value_parts(value))


#: Metadata fields that name who collected a row, in this order.
COLLECTORS = ("surveyor", "recorder", "collector")


def collector_of(metadata: Column) -> Column:
    """The first filled of the collectors' fields in a JSON object, whatever the case of its names; null without any."""
    fields = F.map_entries(F.from_json(metadata, "map<string,string>"))
    named = lambda n: clean(F.get(F.filter(fields, lambda e: F.lower(e["key"]) == n), F.lit(0))["value"])
    return F.coalesce(*[named(n) for n in COLLECTORS])
