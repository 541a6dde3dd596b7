"""URLs as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^(([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def _flat(path: Column) -> Column:
    """A path without dot segments: each part is pushed, `..` pops one."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).when(p == ".", acc).otherwise(F.concat(acc, F.array(p))),
    )
    last = F.element_at(parts, -1)
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))


def resolve(base: Column, link: Column) -> Column:
    """A link as a browser reads it on the page `base`: absolute, scheme-relative, root, query, fragment or relative."""
    scheme, host, path, query = _part(base, 1), _part(base, 3), _part(base, 4), _part(base, 5)
    l_path, l_tail = _part(link, 4), F.concat(_part(link, 5), _part(link, 6))
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    return (
        F.when(_part(link, 1) != "", link)
        .when(_part(link, 3) != "", F.concat(scheme, link))
        .when(F.startswith(l_path, F.lit("/")), F.concat(scheme, host, _flat(l_path), l_tail))
        .when(l_path != "", F.concat(scheme, host, _flat(F.concat(folder, l_path)), l_tail))
        .when(_part(link, 5) != "", F.concat(scheme, host, path, l_tail))
        .otherwise(F.concat(scheme, host, path, query, _part(link, 6)))
    )


def quoted(value: Column) -> Column:
    """Percent-encoded for a query, spaces as %20, slashes kept."""
    return F.replace(F.replace(F.url_encode(value), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def query_string(params: Column) -> Column:
    """name=value pairs of an array of structs (name, value), joined by &."""
    return F.array_join(F.transform(params, lambda p: F.concat(quoted(p["name"]), F.lit("="), quoted(p["value"]))), "&")
