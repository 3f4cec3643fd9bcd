"""Evaluation texts leaking into training text.

Windows of an item's size of the symbols of items and documents go through the CGK walk: a pointer moves along the
window and stays or steps by a random bit of the symbol under it, three steps a symbol, so that windows at a small
edit distance give strings at a small Hamming distance. Random positions of these strings are the keys of the
hash tables; windows that share a key with an item's window are compared by exact edit distance. Items that fit one block are sent to the documents; of more, the keys of
both sides meet in a shuffle, behind a filter of constant size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import spread
from .glyphs import glyphs

#: Words of a window for items in scripts with blanks; letters and digits for items in Chinese.
WORDS, LETTERS = 12, 20
#: Windows of items in one broadcast (40 bytes each and table); more items go through the documents in blocks.
BLOCK_WINDOWS = 500_000
#: Windows of documents handled at once.
CHUNK = 1 << 17
_PLAIN = regex.compile(r"[^\t\n\r\x20-\x7e]")
_ASCII_WORD = regex.compile(r"[a-z0-9]+")
_MARKS = regex.compile(r"^\p{M}+")
_HAN = regex.compile(r"\p{Han}")


class _Cut(dict):
    """Code points to themselves if they are of the kinds, else to ``other``."""

    def __init__(self, kinds: str, other: str):
        super().__init__()
        self.kinds, self.other = kinds, other

    def __missing__(self, cp: int) -> str:
        self[cp] = c = chr(cp) if unicodedata.category(chr(cp))[0] in self.kinds else self.other
        return c


_words, _letters = _Cut("LNM", " "), _Cut("LN", "")


def words(text: str) -> list[str]:
    """Words as they read, in small letters: runs of letters and digits with their marks."""
    if not _PLAIN.search(text):
        return _ASCII_WORD.findall(text.lower())
    found = glyphs(text).casefold().translate(_words).split()
    if any(w[0] >= "\u0300" and unicodedata.category(w[0])[0] == "M" for w in found):  # a mark alone begins no word
        found = [x for w in found if (x := _MARKS.sub("", w))]
    return found


def letters(text: str) -> str:
    """Letters and digits as they read, everything else left out."""
    return glyphs(text).casefold().translate(_letters)


class Symbols(dict):
    """64-bit symbols of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:  # a cache, not a limit
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word) | 1
        return x


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """Random bits of each symbol (splitmix64)."""
    z = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@dataclass(frozen=True)
class Plan:
    """Edits allowed between windows of equal size (a changed word is one, a word more or less two), recall to reach, and sampled positions of a key."""

    edits: int = 0
    recall: float = 0.95
    sample: int = 5

    def tables(self, size: int) -> int:
        """Tables that reach the recall, where a changed symbol changes 3.5 of the sampled stretch's places (measured: 3.2 to 4.4)."""
        if not self.edits:
            return 1  # equal windows share every key
        stay = max(1 - 3.5 * self.edits / (2 * size), 0.2) ** self.sample
        return max(1, ceil(log(1 - self.recall) / log(1 - stay)))

    def places(self, size: int, table: int) -> np.ndarray:
        """Sampled places of the walk: of the two steps a symbol that it takes on average, as behind them most walks have left their window."""
        return np.sort(np.random.default_rng(1000 * size + table).choice(2 * size, self.sample, replace=False))


def keys(symbols: np.ndarray, starts: np.ndarray, size: int, table: int, plan: Plan) -> np.ndarray:
    """Key of each window in one table: the walk's symbols at the sampled places, mixed."""
    bits = _mix(symbols, 7919 * table + size)
    places = set(plan.places(size, table).tolist())
    step = np.zeros(len(starts), np.int64)
    out = np.full(len(starts), np.uint64(table), np.uint64)
    last = len(symbols) - 1
    for j in range(max(places) + 1):
        over = step >= size
        at = np.minimum(starts + step, last)
        if j in places:
            seen = np.where(over, np.uint64(0), symbols[at])
            out = _mix(out ^ seen, j + 1)
        step += np.where(over, 0, ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64))
    return out


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Edits between two windows, most + 1 if more."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        if min(new) > most:
            return most + 1
        row = new
    return min(row[-1], most + 1)


class Index:
    """Windows of a block of items in the tables."""

    def __init__(self, items: list[tuple[int, str]], plan: Plan):
        self.plan = plan
        self.sizes: dict[int, tuple] = {}
        symbol = Symbols()
        streams: dict[int, list] = {WORDS: [], LETTERS: []}
        for k, text in items:
            if _HAN.search(text):
                streams[LETTERS].append((k, np.array([ord(c) for c in letters(text)], np.uint64)))
            else:
                streams[WORDS].append((k, np.array([symbol[w] for w in words(text)], np.uint64)))
        self.all_han = True
        for size, all_ in streams.items():
            all_ = [(k, s) for k, s in all_ if len(s) >= size]
            if not all_:
                continue
            flat = np.concatenate([s for _, s in all_])
            base = np.cumsum([0, *(len(s) for _, s in all_)])
            starts = np.concatenate([np.arange(b, b + len(s) - size + 1) for b, (_, s) in zip(base, all_, strict=False)])
            owner = np.concatenate([np.full(len(s) - size + 1, k, np.int64) for k, s in all_])
            if size == LETTERS:
                han = np.concatenate([[0], np.cumsum((flat >= 0x2E80) & (flat < 0x323B0))])
                self.all_han = bool(np.all(han[starts + size] > han[starts]))
            tables = []
            for t in range(plan.tables(size)):
                key = keys(flat, starts, size, t, plan)
                order = np.argsort(key, kind="stable")
                tables.append((key[order], order))
            self.sizes[size] = (flat, starts, owner, tables, np.unique(flat))

    def search(self, symbols: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(window number, start, item, edits) of the windows within the plan's edits of an item's window.

        An edit brings in at most one symbol, so a window with more symbols that no item has can't be within the edits and isn't walked.
        """
        flat, own_starts, owner, tables, known_symbols = self.sizes[size]
        at = np.minimum(np.searchsorted(known_symbols, symbols), len(known_symbols) - 1)
        strange = np.concatenate([[0], np.cumsum(known_symbols[at] != symbols)])
        starts = starts[strange[starts + size] - strange[starts] <= self.plan.edits]
        seen: set = set()
        for t, (known, order) in enumerate(tables):
            for low in range(0, len(starts), CHUNK):
                part = starts[low : low + CHUNK]
                key = keys(symbols, part, size, t, self.plan)
                left = np.searchsorted(known, key)
                hit = np.flatnonzero(known[np.minimum(left, len(known) - 1)] == key)
                if not len(hit):
                    continue
                right = np.searchsorted(known, key[hit], side="right")
                for h, a, b in zip(hit.tolist(), left[hit].tolist(), right.tolist(), strict=True):
                    at = int(part[h])
                    window = symbols[at : at + size]
                    for o in order[a:b].tolist():
                        if (low + h, o) in seen:
                            continue
                        seen.add((low + h, o))
                        other = flat[own_starts[o] : own_starts[o] + size]
                        if np.array_equal(window, other):
                            yield low + h, at, int(owner[o]), 0
                        elif self.plan.edits:
                            a_, b_ = window.tolist(), other.tolist()
                            # an edit brings in at most one symbol that wasn't there
                            if len(set(b_).difference(a_)) <= self.plan.edits and (d := edit_distance(a_, b_, self.plan.edits)) <= self.plan.edits:
                                yield low + h, at, int(owner[o]), d


SCHEMA = "doc_id bigint, item_id bigint, windows bigint, edits int"


def _streams(b: pd.DataFrame, size: int, symbol: Symbols, skip_plain: bool = False) -> list[tuple[int, np.ndarray]]:
    """(doc_id, symbols) of the documents of a batch that are long enough for a window."""
    out = []
    for k, text in zip(b["doc_id"], b["text"], strict=True):
        if not text or len(text) < size or k is None or k != k:
            continue
        if size == WORDS:
            s = np.array([symbol[w] for w in words(text)], np.uint64)
        elif skip_plain and not _HAN.search(text):
            continue
        else:
            s = np.frombuffer(letters(text).encode("utf-32-le"), np.uint32).astype(np.uint64)
        if len(s) >= size:
            out.append((int(k), s))
    return out


def _windows(streams: list[tuple[int, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all symbols, where each stream begins, where each window begins); no window reaches into the next stream."""
    flat = np.concatenate([s for _, s in streams])
    base = np.cumsum([0, *(len(s) for _, s in streams)])
    return flat, base, np.concatenate([np.arange(a, a + len(s) - size + 1) for a, (_, s) in zip(base, streams, strict=False)])


def find_leaks(docs: DataFrame, items: DataFrame, plan: Plan = Plan(), block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, item_id, windows, edits): how many windows of the document are within ``plan.edits`` edits of a window of the item, and the fewest edits.

    Items are a stated query set against all documents. Up to about ``block`` windows of items are sent to the documents, which are read once and never moved; more are met
    by a shuffle of keys. Windows never reach from one document into the next. Null, empty
    and short texts contain nothing; items shorter than a window can't be contained; equal items each give a row, and so do
    rows of equal documents. A row of a repeated doc_id counts for itself, but in the shuffle, where such rows count as one document.
    """
    docs = spread(docs.select("doc_id", "text"))
    stated = items.select("item_id", "text").where("item_id is not null and text is not null")
    size = stated.agg(F.sum(F.length("text")).alias("n")).head().n or 0
    if size // 4 > block:
        return _by_keys(docs, stated, plan)
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(Index([(r.item_id, r.text) for r in stated.toLocalIterator()], plan))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, symbol = index.value, Symbols()
        for b in batches:
            rows: list[tuple] = []
            for size in known.sizes:
                if not (streams := _streams(b, size, symbol, known.all_han)):
                    continue
                flat, base, starts = _windows(streams, size)
                found: dict = {}
                for _, at, item, edits in known.search(flat, starts, size):
                    d = int(np.searchsorted(base, at, side="right")) - 1
                    have = found.setdefault((d, item), [set(), edits])
                    have[0].add(at)
                    have[1] = min(have[1], edits)
                rows += [(streams[d][0], item, len(at), edits) for (d, item), (at, edits) in found.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "windows", "edits"])

    return docs.mapInPandas(run, SCHEMA)


#: Bits of the filter that keeps windows of documents from the shuffle that share no key with an item; it only saves work.
FILTER = 1 << 26
_KEYED = "doc_id bigint, size int, key bigint, start bigint, window array<bigint>"


def _keyed(plan: Plan, chinese: bool | None = None, sieve=None):
    """What makes (doc_id, size, key, start, window) of all windows and tables of a batch. ``chinese`` tells whether texts are cut by letters if they hold Chinese, and by words else."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol = Symbols()
        for b in batches:
            for size in (WORDS, LETTERS):
                some = b
                if chinese:
                    han = b["text"].map(lambda t: bool(t and _HAN.search(t)))
                    some = b[han == (size == LETTERS)]
                for one in _streams(some, size, symbol):
                    flat, _, starts = _windows([one], size)
                    for t in range(plan.tables(size)):
                        key = keys(flat, starts, size, t, plan).view(np.int64)
                        kept = np.arange(len(key)) if sieve is None else np.flatnonzero(sieve.value[(key.view(np.uint64) % np.uint64(FILTER)).astype(np.int64)])
                        for low in range(0, len(kept), CHUNK // 16):
                            at = kept[low : low + CHUNK // 16]
                            yield pd.DataFrame({"doc_id": one[0], "size": size, "key": key[at], "start": starts[at], "window": list(flat[starts[at][:, None] + np.arange(size)].view(np.int64))})

    return run


def _by_keys(docs: DataFrame, items: DataFrame, plan: Plan) -> DataFrame:
    """The same for any number of items: windows meet by key. A key that many documents share meets the few items' windows that have it; AQE splits it."""
    spark = docs.sparkSession
    of_items = items.select(F.col("item_id").alias("doc_id"), "text").mapInPandas(_keyed(plan, chinese=True), _KEYED).select(F.col("doc_id").alias("item_id"), "size", "key", F.col("window").alias("other")).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    bits = np.zeros(FILTER, bool)
    for r in of_items.select(F.expr(f"cast(((key % {FILTER}) + {FILTER}) % {FILTER} as int)").alias("bit")).distinct().toLocalIterator():
        bits[r.bit] = True
    sieve = spark.sparkContext.broadcast(bits)
    of_docs = docs.mapInPandas(_keyed(plan, sieve=sieve), _KEYED)
    # a window meets each window of an item once, whatever number of tables brings them together
    met = of_docs.join(of_items, ["size", "key"]).select("doc_id", "item_id", "start", "size", "window", "other").distinct()
    same = met.where(F.col("window") == F.col("other")).select("doc_id", "item_id", "start", "size", F.lit(0).alias("edits"))
    near = met.where(F.lit(bool(plan.edits)) & (F.col("window") != F.col("other")) & (F.size(F.array_except("other", "window")) <= plan.edits))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = [edit_distance(x.tolist(), y.tolist(), plan.edits) for x, y in zip(b["window"], b["other"], strict=True)]
            yield b[["doc_id", "item_id", "start", "size"]].assign(edits=d)

    compared = near.mapInPandas(verify, "doc_id bigint, item_id bigint, start bigint, size int, edits int").where(F.col("edits") <= plan.edits)
    return same.unionAll(compared).groupBy("doc_id", "item_id").agg(F.countDistinct("size", "start").alias("windows"), F.min("edits").alias("edits"))


#: The search of both queries: one changed word a window, or letter of a Chinese one.
SEARCH = Plan(edits=1)


def contained(docs: DataFrame, items: DataFrame, plan: Plan = SEARCH) -> DataFrame:
    """(doc_id, item_id), once each: of what the search finds, the documents that hold a whole window of the item unchanged as it reads. Equal windows share every key, so none is lost."""
    return find_leaks(docs, items, plan).where("edits = 0").select("doc_id", "item_id").distinct()


def leaked_documents(docs: DataFrame, items: DataFrame, plan: Plan = SEARCH) -> DataFrame:
    """(doc_id, items, windows, fewest_edits) of every document that holds a passage of an item, up to the plan's edits a window."""
    return find_leaks(docs, items, plan).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.sum("windows").alias("windows"), F.min("edits").alias("fewest_edits"))
