"""Canonical form and identity of texts in DuckDB's SQL, for comparison: characters unfolded, mapped by a table made from the Unicode data, and put together again."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from ..functions import vocab

SPACES = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@lru_cache(1)
def _tables() -> tuple[str, str]:
    """(compatibility forms, case folds) as rows of a VALUES list; what canonical composition alone does is left to the engine."""
    compat, fold = [], []
    for cp in range(1, 0x20000):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000 or unicodedata.category(c) == "Cn":
            continue
        if (m := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c):
            compat.append((c, m))
        if (m := c.casefold()) != c:
            fold.append((c, m))
    rows = lambda pairs: ", ".join("({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in p)) for p in pairs)
    return rows(compat), rows(fold)


def identity_ctes(source: str, name: str = "ids") -> str:
    """CTEs that end in ``name``(v, canonical, folded, identity) of the distinct values v of ``source``, a query with the column v."""
    compat, fold = _tables()
    dashes = "".join(vocab.HYPHENS)
    return rf"""
{name}_v AS (SELECT DISTINCT v FROM ({source}) WHERE v IS NOT NULL),
{name}_compat(c, m) AS (VALUES {compat}), {name}_fold(c, m) AS (VALUES {fold}),
{name}_c AS (SELECT v, unnest(regexp_extract_all(v, '(?s).')) AS c, generate_subscripts(regexp_extract_all(v, '(?s).'), 1) AS i FROM {name}_v),
{name}_n AS (SELECT v, nfc_normalize(string_agg(coalesce(m, x.c), '' ORDER BY i)) AS s FROM {name}_c x LEFT JOIN {name}_compat USING (c) GROUP BY v),
{name}_s AS (SELECT v, trim(regexp_replace(regexp_replace(s, '[{dashes}]', '-', 'g'), '{SPACES}+', ' ', 'g')) AS canonical FROM {name}_n),
{name}_f AS (SELECT t AS w, string_agg(coalesce(m, x.c), '' ORDER BY i) AS folded FROM (SELECT t, unnest(regexp_extract_all(t, '(?s).')) AS c, generate_subscripts(regexp_extract_all(t, '(?s).'), 1) AS i
  FROM (SELECT canonical AS t FROM {name}_s UNION SELECT v FROM {name}_v)) x LEFT JOIN {name}_fold USING (c) GROUP BY t),
{name} AS (SELECT a.v, coalesce(canonical, '') AS canonical, coalesce(f.folded, '') AS folded, coalesce(g.folded, '') AS identity
  FROM {name}_v a LEFT JOIN {name}_s b ON a.v = b.v LEFT JOIN {name}_f f ON f.w = a.v LEFT JOIN {name}_f g ON g.w = b.canonical)"""
