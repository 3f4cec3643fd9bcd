"""Canonical text identity and the scalar functions built on it, as columns."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from . import vocab

#: Unicode White_Space, without the separators U+001C to U+001F that Python's split adds.
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
_HYPHENS = str.maketrans(dict.fromkeys(vocab.HYPHENS, "-"))
#: Not preceded, and not followed, by a letter, digit or underscore; both engines read it alike.
LEFT, RIGHT = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def canonical_text(value: str) -> str:
    """NFKC, one kind of hyphen, single spaces, no spaces at the ends."""
    return _SPACES.sub(" ", unicodedata.normalize("NFKC", value).translate(_HYPHENS)).strip(" ")


def identity_text(value: str) -> str:
    return canonical_text(value).casefold()


def _each(series: pd.Series, f) -> pd.Series:
    seen: dict = {}
    out = []
    for v in series:
        if v is not None and v not in seen:
            seen[v] = f(v)
        out.append(None if v is None else seen[v])
    return pd.Series(out, dtype=object)


@F.pandas_udf(StringType())
def _canonical_any(s: pd.Series) -> pd.Series:
    return _each(s, canonical_text)


@F.pandas_udf(StringType())
def _identity_any(s: pd.Series) -> pd.Series:
    return _each(s, identity_text)


def canonical(c: Column) -> Column:
    """Canonical form of any text; null stays null, blank becomes empty. One Arrow batch of values at a time."""
    return _canonical_any(c)


def identity(c: Column) -> Column:
    """Key under which two spellings are the same: the canonical form in full case fold."""
    return _identity_any(c)


@F.pandas_udf(StringType())
def _folded_any(s: pd.Series) -> pd.Series:
    return _each(s, str.casefold)


def case_fold(c: Column) -> Column:
    """Full case folding alone, without canonicalization."""
    return _folded_any(c)


@F.pandas_udf(ArrayType(StructType([StructField(x, StringType()) for x in ("canonical", "identity", "folded")])))
def _forms_any(s: pd.Series) -> pd.Series:
    seen: dict = {None: None}

    def one(v):
        if v not in seen:
            seen[v] = {"canonical": (c := canonical_text(v)), "identity": c.casefold(), "folded": v.casefold()}
        return seen[v]

    return pd.Series([None if a is None else [one(v) for v in a] for a in s], dtype=object)


def text_forms(c: Column) -> Column:
    """Of each text of a list its canonical form, identity and case fold; nulls stay null."""
    return _forms_any(c)


def least_spellings(values) -> list[str]:
    """Of each identity the least spelling, in sort order; nulls fall away."""
    least: dict[str, str] = {}
    for v in values:
        if v is not None:
            k = identity_text(v)
            least[k] = min(least.get(k, v), v)
    return [v for _, v in sorted(least.items())]


@F.pandas_udf(ArrayType(StringType()))
def _least_any(s: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else least_spellings(a) for a in s], dtype=object)


def sorted_unique_strings(c: Column) -> Column:
    """A list's different texts by identity, the least spelling of each, in sort order; null stays null. Folded inside the row."""
    return _least_any(c)


def ascii_identity(c: Column) -> Column:
    """The same for columns known to be ASCII, inside code generation."""
    return F.lower(F.trim(F.regexp_replace(c, r"[\t-\r ]+", " ")))


def sort_key(c: Column) -> Column:
    """What records and lists are ordered by: the identity, then the text itself."""
    return F.struct(identity(c).alias("identity"), c.alias("value"))


def any_of(c: Column, alternatives: str, ends: bool = True) -> Column:
    """Whether a whole word (or, without ``ends``, a word's beginning) of the text is one of the alternatives."""
    return c.rlike(f"(?i){LEFT}({alternatives})" + (RIGHT if ends else ""))


def lookup(c: Column, table: dict) -> Column:
    """Value of a small fixed table, null where it has none."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c]


def wiki_title(c: Column) -> Column:
    """Identity of a title, in which underscores are blanks."""
    return identity(F.replace(c, F.lit("_"), F.lit(" ")))


def category_leaf(c: Column) -> Column:
    return F.regexp_replace(wiki_title(c), "^category:", "")


def primary_class(c: Column) -> Column:
    return lookup(category_leaf(c), vocab.CLASS_ALIASES)


def subclass(c: Column) -> Column:
    return lookup(category_leaf(c), vocab.SUBCLASS_ALIASES)


def nation(c: Column) -> Column:
    return lookup(identity(c), vocab.NATION_ALIASES)


def nation_from_category(c: Column) -> Column:
    leaf = category_leaf(c)
    return F.coalesce(lookup(leaf, vocab.NATION_ALIASES), lookup(F.regexp_replace(leaf, " tanks?$", ""), vocab.NATION_ALIASES))


def tier_from_category(c: Column) -> Column:
    """1 to 10 from ``tier VII tanks`` or ``tier 7``; null for anything else."""
    token = F.regexp_extract(category_leaf(c), r"^tier ([ivxlcdm]+|\d{1,3})(?: tanks?)?$", 1)
    tier = F.coalesce(lookup(token, vocab.ROMAN_TIERS), F.when(token.rlike(r"^\d+$"), token.cast("int")))
    return F.when(tier.between(1, 10), tier)


def is_organizational(c: Column) -> Column:
    return category_leaf(c).isin(vocab.ORGANIZATIONAL)


def tank_suffix(c: Column) -> Column:
    """What follows ``Tank:`` in a title; null if it has no such prefix."""
    rest = F.regexp_extract(c, r"^(?i:tank):(.+)$", 1)
    return F.when(rest != "", rest)


def normalize_statement(c: Column) -> Column:
    """A statement in canonical form, without citation marks and bullets."""
    plain = F.regexp_replace(canonical(c), r"(?i)\s*(\[(\d+|citation needed)\]|\(\s*source\s*\))\s*", " ")
    spaced = F.trim(F.regexp_replace(plain, r"[\t-\r \x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+", " "))
    return F.regexp_replace(spaced, "^[•*\\- ]+|[• ]+$", "")


def safe_url(c: Column) -> Column:
    """Host, port and path only."""
    return F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?", ""), r"[?#].*$", "")


def json_path(record: Column, field: Column, item: Column) -> Column:
    """``$[i].field[j]`` of a violation."""
    return F.concat(F.concat(F.lit("$["), record.cast("string"), F.lit("]")), F.coalesce(F.concat(F.lit("."), field), F.lit("")), F.coalesce(F.concat(F.lit("["), item.cast("string"), F.lit("]")), F.lit("")))


def backoff_seconds(attempt: Column) -> Column:
    return F.least(F.lit(15.0), F.greatest(F.lit(5.0), F.pow(F.lit(2.0), attempt - 1)))


def ceil_micros(ns: Column) -> Column:
    return F.ceil(ns / 1000)


def truncate_message(c: Column, most: int = 200) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)
