"""URLs: splitting, dot segments, resolving a link against its page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generic URI syntax: scheme, authority, path, query, fragment.
_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = 1, 2, 3, 4, 5


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URI, group)


def _remove_dot_segments(path: Column) -> Column:
    """Drop '.' segments and let each '..' take its parent away."""
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        F.slice(segments, 2, F.size(segments)),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    # a path that ends in a dot segment names a folder
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    clean = F.concat(F.lit("/"), F.array_join(closed, "/"))
    return F.when(F.contains(path, F.lit("/.")), clean).otherwise(path)


def resolve_url(base: Column, link: Column) -> Column:
    """The absolute form of `link` as found on the page `base`."""
    site = F.concat(_part(base, _SCHEME), F.lit("://"), _part(base, _AUTHORITY))
    base_path, base_query = _part(base, _PATH), _part(base, _QUERY)
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    path, query, fragment = _part(link, _PATH), _part(link, _QUERY), _part(link, _FRAGMENT)
    suffix = F.concat(query, fragment)
    return (
        F.when(link == "", base)
        .when(_part(link, _SCHEME) != "", link)
        .when(_part(link, _AUTHORITY) != "", F.concat(_part(base, _SCHEME), F.lit(":"), link))
        .when(
            path == "",
            F.concat(site, base_path, F.when(query == "", base_query).otherwise(query), fragment),
        )
        .when(path.startswith("/"), F.concat(site, _remove_dot_segments(path), suffix))
        .otherwise(F.concat(site, _remove_dot_segments(F.concat(folder, path)), suffix))
    )
