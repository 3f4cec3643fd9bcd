"""Web addresses as columns."""

from __future__ import annotations

from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocab

#: Escapes are read at most so often: an address may be escaped twice by accident, not without end.
READINGS = 3


def resolved_path(raw: str) -> str | None:
    """Path without escapes, backslashes, empty and dot segments; a last slash stays. None if it holds a null character."""
    plain = raw
    for _ in range(READINGS):
        plain = unquote(plain)
    if "\0" in plain:
        return None
    kept: list[str] = []
    for part in plain.replace("\\", "/").split("/"):
        if part == "..":
            del kept[-1:]
        elif part not in ("", "."):
            kept.append(part)
    last = "/" if kept and plain[-1:] in ("/", "\\") else ""
    return "/" + "/".join(kept) + last


@F.pandas_udf(StringType())
def _paths(s: pd.Series) -> pd.Series:
    made = {raw: None if (p := resolved_path(raw)) is None else quote(p, safe="/:@-._~") for raw in s.dropna().unique()}
    return s.map(lambda raw: made.get(raw))


def _coded(c: Column) -> Column:
    """As a form's value, in the way browsers write it."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _read(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def clean_query(query: Column) -> Column:
    """The items of a query that don't only track, decoded, in the order of name and value, encoded again. Items without a value get an empty one."""
    items = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.struct(_read(F.regexp_extract(x, "^[^=]*", 0)).alias("k"), _read(F.regexp_replace(x, "^[^=]*=?", "")).alias("v")))
    keyed = F.transform(items, lambda x: F.struct(F.lower(x["k"]).alias("low"), x["k"].alias("k"), x["v"].alias("v")))
    kept = F.array_sort(F.filter(keyed, lambda x: ~x["low"].isin(vocab.TRACKING_KEYS) & ~x["low"].startswith("utm_")))
    return F.array_join(F.transform(kept, lambda x: F.concat(_coded(x["k"]), F.lit("="), _coded(x["v"]))), "&")


def clean_address(url: Column) -> Column:
    """One form of a web address: scheme and host in small letters, no default port, resolved path, sorted query without tracking, no fragment.

    Null for null, for what isn't an absolute http or https address, has no host, names a user, or has a port that is none. Only the path leaves the engine.
    """
    text = F.trim(url)
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    authority = F.regexp_extract(text, r"^[^:/?#]+://([^/?#]*)", 1)
    host = F.lower(F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:@]+)(?::\d*)?$", 1))
    port = F.regexp_extract(authority, r":(\d+)$", 1)
    path = _paths(F.regexp_extract(text, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1))
    query = clean_query(F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1))
    usual = F.create_map(F.lit("http"), F.lit("80"), F.lit("https"), F.lit("443"))[scheme]
    shown = F.when((port != "") & (port != usual), F.concat(F.lit(":"), port)).otherwise("")
    good = scheme.isin("http", "https") & (host != "") & F.coalesce(port.try_cast("int") <= 65535, port == "")
    return F.when(good, F.concat(scheme, F.lit("://"), host, shown, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))
