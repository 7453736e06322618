"""URL text: escaping, query strings, command keys.

Path segments and query parts escape differently. `url_encode` writes form
encoding, so both start from it and put back what their rule leaves plain.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hubloom.functions.json_values import query_value

# Form encoding -> what a query part and a path segment hold.
QUERY_FIXES = (("*", "%2A"), ("%7E", "~"))
PATH_FIXES = QUERY_FIXES + (
    ("+", "%20"), ("%24", "$"), ("%26", "&"), ("%2B", "+"), ("%3A", ":"),
    ("%3D", "="), ("%40", "@"),
)

BAD_ESCAPE = "%(?![0-9A-Fa-f]{2})"


def _fixed(text: Column, fixes) -> Column:
    for old, new in fixes:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def query_escape(text: Column) -> Column:
    return _fixed(F.url_encode(text), QUERY_FIXES)


def path_escape(text: Column) -> Column:
    return _fixed(F.url_encode(text), PATH_FIXES)


def encode_values(values: Column) -> Column:
    """Query string of a `map<string, array<string>>`, names in order."""
    by_name = F.array_sort(F.map_keys(values))
    pairs = F.transform(by_name, lambda name: F.transform(
        F.element_at(values, name),
        lambda value: F.concat(query_escape(name), F.lit("="), query_escape(value))))
    return F.coalesce(F.array_join(F.flatten(pairs), "&"), F.lit(""))


def command_key(action: Column, network_id: Column, deployment_id: Column,
                inputs: Column | None = None) -> Column:
    """Escaped `action/hub/deployment?inputs`, the same for equal commands."""
    path = F.concat_ws("/", action, path_escape(network_id.cast("string")),
                       path_escape(deployment_id.cast("string")))
    if inputs is None:
        return path
    query = encode_values(inputs)
    return F.when(query == "", path).otherwise(F.concat(path, F.lit("?"), query))


def query_of(url: Column) -> Column:
    """Query string of a URL: behind the first `?`, before any `#`."""
    plain = F.substring_index(url, "#", 1)
    start = F.instr(plain, "?")
    return F.when(start > 0, plain.substr(start + 1, F.length(plain))).otherwise(F.lit(""))


def query_pairs(query: Column) -> Column:
    """Readable `{name, value}` pairs of a query string, in its order.

    Empty parts, parts with a `;` and parts with a bad escape are skipped. The
    escapes are checked first: decoding alone would read `%+1`.
    """
    parts = F.filter(
        F.split(F.coalesce(query, F.lit("")), "&"),
        lambda part: (part != "") & ~F.contains(part, F.lit(";")) & ~part.rlike(BAD_ESCAPE))

    def pair(part: Column) -> Column:
        cut = F.instr(part, "=")
        name = F.when(cut > 0, part.substr(F.lit(1), cut - 1)).otherwise(part)
        value = F.when(cut > 0, part.substr(cut + 1, F.length(part))).otherwise(F.lit(""))
        return F.struct(F.try_url_decode(name).alias("name"),
                        F.try_url_decode(value).alias("value"))

    return F.filter(F.transform(parts, pair),
                    lambda p: p["name"].isNotNull() & p["value"].isNotNull())


def first_values(pairs: Column) -> Column:
    """Keep the first pair of each name."""
    names = F.transform(pairs, lambda p: p["name"])
    return F.filter(pairs, lambda p, i: F.array_position(names, p["name"]) == i + 1)


def parse_query(query: Column) -> Column:
    """Query string -> `map<string, variant>`: the first value of each name as
    a JSON value, or as plain text where it is not JSON."""
    return F.map_from_entries(F.transform(
        first_values(query_pairs(query)),
        lambda p: F.struct(p["name"], query_value(p["value"]))))


def query_values(query: Column) -> Column:
    """Query string -> `map<string, array<string>>` with all values by name."""
    pairs = query_pairs(query)
    return F.map_from_entries(F.transform(
        F.array_distinct(F.transform(pairs, lambda p: p["name"])),
        lambda name: F.struct(name, F.transform(
            F.filter(pairs, lambda p: p["name"] == name), lambda p: p["value"]))))


def canonical_query(query: Column) -> Column:
    """The same query string for all ways to write it: decoded, sorted by name,
    escaped again."""
    return encode_values(query_values(query))
