"""How lines of a page look from outside: what density says of a form of line on all pages, for lines that density can't place.

The density of a page leaves some of its blocks outside the body or finds them linked. Counted over all pages by how lines
begin, end and read as a whole, this tells which forms of line belong to what sites put around their texts. A line is then judged
by the most specific of its forms that is known, wherever it stands: inside a body, or in a text without tags. Nothing is listed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANKS = re.compile(r"\s+")
_TOKEN = re.compile(r"\w+(?:[-'’.,]\w+)*|([^\w\s])\1*")
_UNSPACED = re.compile(r"[぀-ヿ一-鿿]")
_DIGIT = re.compile(r"\d")
#: A form tells something if it holds a letter that isn't masked, or a mark that joins things.
_TELLING = re.compile(r"[^\W\d_N]|[^\W\d_]{2}|[#:|>/·•©：]")
#: Forms of at most this many are sent to the tasks; more are joined by a shuffle. 12 bytes each.
FEW = 4_000_000


def tidy(line: str) -> str:
    return _BLANKS.sub(" ", line).strip()


def form_id(form: str) -> int:
    x = xxhash.xxh3_64_intdigest(form.encode("utf-8", "replace"))
    return x - (1 << 64) if x >> 63 else x


def _masked(word: str) -> str:
    """A word in small letters; one with a digit only keeps a mark that it begins with."""
    if word.isalpha() or not _DIGIT.search(word):
        return word
    return "0" if word[0].isalnum() else word[0] + "0"


def _words(line: str) -> tuple[list[str], list[str]]:
    """(as they stand, with names masked as well) between blanks; a run of names is one."""
    given = line.split(" ")
    plain = [_masked(w) for w in line.lower().split(" ")]
    if len(given) != len(plain):  # a letter whose small form has a blank in it
        plain = [_masked(w.lower()) for w in given]
    named = plain[:1]
    for w, p in zip(given[1:], plain[1:], strict=True):
        if not w[0].isupper():
            named.append(p)
        elif named[-1] != "N":
            named.append("N")
    return plain, named


def _letters(line: str) -> tuple[list[str], list[str]]:
    """The same of a line in a script without blanks: its letters, and the words of other scripts in it."""
    plain, named = [], []
    for i, m in enumerate(_TOKEN.finditer(line)):
        w = m[0]
        if _UNSPACED.search(w):
            plain += w
            named += w
            continue
        p = _masked(w.lower()) if w[0].isalnum() else w[0]
        plain.append(p)
        if not (i and w[0].isupper()):
            named.append(p)
        elif not named or named[-1] != "N":
            named.append("N")
    return plain, named


def forms(line: str) -> list[list[str]]:
    """Groups of forms of a tidy line, in each the most specific first: the whole of it, how it begins, goes on after its first word, and ends."""
    line = line.replace("...", "…")
    unspaced = _UNSPACED.search(line)
    plain, named = _letters(line) if unspaced else _words(line)
    a, b, c = (2, 3, 5) if unspaced else (1, 2, 3)
    n = len(plain)
    return [
        ["w" + " ".join(plain)],
        ["w" + " ".join(named)],
        ["p" + " ".join(plain[:k]) for k in (c + 2, c, b, a) if n >= k],
        ["p" + " ".join(named[:k]) for k in (c + 2, c) if len(named) >= k],
        ["q" + " ".join(plain[1 : 1 + k]) for k in (c, b, a) if n > k and (k > a or plain[k][-1] == ":")],
        ["s" + " ".join(plain[-k:]) for k in (c, b, a) if n >= k],
    ]


class Known:
    """Share of each known form's lines that stand outside, held as two arrays sorted by form."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.shares = ids[order], shares[order]

    def shares_of(self, ids: list[int]) -> list[float | None]:
        if not len(self.ids):
            return [None] * len(ids)
        want = np.array(ids, np.int64)
        at = np.minimum(np.searchsorted(self.ids, want), len(self.ids) - 1)
        return [s if h else None for h, s in zip((self.ids[at] == want).tolist(), self.shares[at].tolist(), strict=True)]


def telling(line: str) -> list[tuple[str, list[int]]]:
    """(kind, ids of the forms that tell something) of each group of a tidy line's forms."""
    return [(g[0][0], ids) for g in forms(line) if g and (ids := [form_id(f) for f in g if _TELLING.search(f, 1)])]


def ids_of(lines: Iterable[str]) -> set[int]:
    return {i for line in lines for _, ids in telling(line) for i in ids}


class Lines:
    """Judges lines by known forms. ``most`` is the share from which a form counts as one of what sites put around texts."""

    def __init__(self, shares_of: Callable[[list[int]], list[float | None]], most: float = 0.3):
        self.shares_of, self.most = shares_of, most
        self.seen: dict[str, float] = {}

    def outside(self, line: str) -> float:
        """The share outside of the whole line's form if that is known, else the highest among its beginning and its end; 0 if nothing is known."""
        return self.all_outside([line])[0]

    def all_outside(self, lines: list[str]) -> list[float]:
        """The same of each line; all of them are looked up at once."""
        seen = self.seen
        if len(seen) > 200_000:  # a cache, not a limit
            seen.clear()
        fresh = {line: telling(line) for line in lines if line not in seen}
        flat = [i for told in fresh.values() for _, ids in told for i in ids]
        shares, at = self.shares_of(flat) if flat else [], 0
        for line, told in fresh.items():
            best = whole = None
            for kind, ids in told:
                if whole is None:
                    known = next((s for s in shares[at : at + len(ids)] if s is not None), None)
                    if known is not None:
                        if kind == "w":
                            whole = known
                        elif best is None or known > best:
                            best = known
                at += len(ids)
            seen[line] = whole if whole is not None else best or 0.0
        return [seen[line] for line in lines]

    def all_furniture(self, lines: list[str]) -> list[bool]:
        """Whether each tidy line looks like what sites put around their texts. Blank lines do."""
        return [not line or share >= self.most for line, share in zip(lines, self.all_outside(lines), strict=True)]

    def furniture(self, line: str) -> bool:
        return self.all_furniture([line])[0]


def form_shares(placed: DataFrame, least: int = 8) -> DataFrame:
    """(form bigint, share float) of forms that ``least`` lines have; ``placed`` is (form, lines, outside), summed in the tasks before the shuffle."""
    total = placed.groupBy("form").agg(F.sum("lines").alias("n"), F.sum("outside").alias("out"))
    return total.where(F.col("n") >= least).select("form", (F.col("out") / F.col("n")).cast("float").alias("share"))


class Learned:
    """The known forms where the tasks need them: in a broadcast while they are few, else beside each row by joins. Decisions are the same."""

    def __init__(self, shares: DataFrame, few: int = FEW):
        self.shares = shares.persist(StorageLevel.MEMORY_AND_DISK)
        self.few = self.shares.count() <= few
        self.broadcast = None
        if self.few:
            rows = self.shares.toArrow()
            known = Known(rows["form"].to_numpy().astype(np.int64), rows["share"].to_numpy().astype(np.float32))
            self.broadcast = shares.sparkSession.sparkContext.broadcast(known)

    def beside(self, rows: DataFrame, key: str, text: str, lines_of: Callable[[str], list[str]]) -> DataFrame:
        """``rows`` with (known_forms, known_shares): null while the forms are in the broadcast, else those among the row's forms. ``key`` tells rows apart."""
        none = [F.lit(None).cast(t).alias(c) for c, t in (("known_forms", "array<bigint>"), ("known_shares", "array<float>"))]
        if self.few:
            return rows.select("*", *none)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"key": b["key"], "form": [sorted(ids_of(lines_of(t))) if t else [] for t in b["text"]]})

        key_type = rows.schema[key].dataType.simpleString()
        asked = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {key_type}, form array<bigint>").select("key", F.explode("form").alias("form")).distinct()
        found = asked.join(self.shares, "form").groupBy("key").agg(F.collect_list("form").alias("known_forms"), F.collect_list("share").alias("known_shares"))
        return rows.join(found.withColumnRenamed("key", key), key, "left")

    def judge(self) -> Callable[[object, object], Lines]:
        """What makes the judge of a row from its two columns, for use inside a task."""
        broadcast, one = self.broadcast, []

        def of(ids, shares) -> Lines:
            if broadcast is not None:
                if not one:
                    one.append(Lines(broadcast.value.shares_of))
                return one[0]
            table = {} if ids is None else dict(zip((int(i) for i in ids), (float(s) for s in shares), strict=True))
            return Lines(lambda want: [table.get(i) for i in want])

        return of


def host_of(url: Column) -> Column:
    """Site of an address, in small letters; null without an address."""
    plain = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z]+://(?:www\.)?|[?#].*", "")
    return F.nullif(F.substring_index(plain, "/", 1), F.lit(""))
