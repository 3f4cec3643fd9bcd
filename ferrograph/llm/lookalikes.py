"""Visually identical text with different characters.

Known spellings form a trie; a value's characters, decomposed, drive a weighted edit automaton over it, whose edges for look-alikes, type styles,
kinds of dash and blank, and ignorables cost nothing, those between cases and for marks half, and all others one. A value
that ends in a final state within the budget gets the canonical spelling; the tokens of others are looked up
in a trie of the labels' words and, where that has none, spelled by table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import spread
from .glyphs import glyphs, spell, zero_cost

#: Labels in one trie, and so in one broadcast (about 200 bytes a label and character); more are done in blocks of this size.
BLOCK = 200_000


class Trie:
    """Trie over glyphs; each final node holds the entries that read so."""

    def __init__(self, entries: Iterable[tuple[str, object]]):
        self.next: list[dict[str, int]] = [{}]
        self.final: dict[int, list] = {}
        for text, value in entries:
            if not (seen := glyphs(text)):
                continue  # a blank label reads like nothing
            node = 0
            for c in seen:
                if (to := self.next[node].get(c)) is None:
                    to = self.next[node][c] = len(self.next)
                    self.next.append({})
                node = to
            self.final.setdefault(node, []).append(value)

    def read(self, value: str) -> list[object]:
        """Entries that a value reads like: the automaton's walk along edges of no cost. Blanks take their edge when something follows them."""
        node, blank, step, edges = 0, False, self.next, zero_cost()
        for c in unicodedata.normalize("NFKD", value):
            seen = edges[ord(c)]
            if seen is None:
                continue
            if seen == " ":
                blank = node != 0
                continue
            if blank:
                blank = False
                if (node := step[node].get(" ")) is None:
                    return []
            for x in seen:
                if (node := step[node].get(x)) is None:
                    return []
        return self.final.get(node, []) if node else []

    def find(self, value: str, budget: float = 0) -> list[tuple[float, object]]:
        """(cost, entry) of everything within the budget. Branches whose cheapest state is beyond it are left."""
        if found := self.read(value):
            found = [(0.0, v) for v in found]
        seen = glyphs(value)
        if not budget or not seen:
            # marks that only meet once ignorables between them are gone are in another order: the reading itself is walked
            return found or ([(0.0, v) for v in self.read(seen)] if seen != value else [])
        n, band, inf = len(seen), int(budget / 0.5), budget + 1  # no edge that isn't free costs less than a half, so states further from the diagonal are beyond the budget
        drop = [_gap(c) for c in seen]
        row = [0.0]
        for w in drop[:band]:
            row.append(row[-1] + w)
        best: dict = {}
        stack = [(0, 0, 0, row)]  # node, its depth, the first place of the row, costs of the value's first letters from there
        while stack:
            node, depth, low, row = stack.pop()
            if low + len(row) > n and row[n - low] <= budget:
                for v in self.final.get(node, ()):
                    best[v] = min(best.get(v, row[n - low]), row[n - low])
            at, end = max(0, depth + 1 - band), min(n, depth + 1 + band)
            if at > n:
                continue
            for c, to in self.next[node].items():
                gap, new = _gap(c), []
                for i in range(at, end + 1):
                    j = i - low
                    cost = row[j] + gap if j < len(row) else inf
                    if i:
                        if new and (x := new[-1] + drop[i - 1]) < cost:
                            cost = x
                        if 0 < j <= len(row):
                            have = seen[i - 1]
                            x = row[j - 1] if have == c else row[j - 1] + _swap(have, c)
                            if x < cost:
                                cost = x
                    new.append(cost)
                if min(new) <= budget:
                    stack.append((to, depth + 1, at, new))
        return sorted(((cost, v) for v, cost in best.items()), key=lambda x: (x[0], str(x[1])))


@lru_cache(20_000)
def _gap(c: str) -> float:
    """Cost of a glyph that only one side has."""
    return 0.5 if c in " -" or unicodedata.combining(c) else 1.0


@lru_cache(100_000)
def _swap(a: str, b: str) -> float:
    """Cost of one glyph for another."""
    return 0.5 if a.casefold() == b.casefold() or {a, b} == {" ", "-"} else 1.0


def field_values(df: DataFrame, key: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """(key, field, item_no, value) of every value that isn't null; item_no is 0 for scalars, else the position, nulls counted."""
    item = lambda f, i, v: F.struct(F.lit(f).alias("field"), i.cast("int").alias("item_no"), v.alias("value"))
    parts = [F.array(item(f, F.lit(0), F.col(f"`{f}`"))) for f in scalars]
    none = F.array().cast("array<struct<field:string,item_no:int,value:string>>")

    def items(f: str):
        return F.coalesce(F.transform(f"`{f}`", lambda v, i: item(f, i, v)), none)

    parts += [items(f) for f in lists]
    return df.select(F.col(f"`{key}`").alias(key), F.inline(F.concat(*parts))).where("value is not null")


def _tries(spark, labels: DataFrame, block: int):
    """Broadcasts of (label trie of each field, word trie of each field), of at most ``block`` labels each."""
    rows = labels.select("label_id", "field", "label").where("label is not null")
    batch: list = []

    def built(batch):
        fields = {r.field for r in batch}
        whole = {f: Trie((r.label, (r.label_id, r.label)) for r in batch if r.field == f) for f in fields}
        words = {f: Trie((w, w) for w in sorted({w for r in batch if r.field == f for w in r.label.split()})) for f in fields}
        return spark.sparkContext.broadcast((whole, words))

    for r in rows.toLocalIterator():
        batch.append(r)
        if len(batch) == block:
            yield built(batch)
            batch = []
    if batch:
        yield built(batch)


def match_labels(df: DataFrame, labels: DataFrame, key: str, scalars: list[str], lists: list[str], budget: float = 0, block: int = BLOCK) -> DataFrame:
    """(field, key, item_no, value, label_id, label, cost): values that reach a label of their field within the budget.

    One pass of map tasks over the table for each ``block`` labels; no shuffle, so a hot value only costs
    the rows it has. Null values and blank ones match nothing; labels of equal reading all match; an empty
    table or no labels give no rows. Extra columns are ignored.
    """
    values = field_values(spread(df.select(*{key, *scalars, *lists})), key, scalars, lists)
    key_type = df.schema[key].dataType.simpleString()
    schema = f"field string, `{key}` {key_type}, item_no int, value string, label_id bigint, label string, cost double"
    out = None
    for known in _tries(df.sparkSession, labels, block):

        def run(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            whole, _ = known.value
            seen: dict = {}
            for b in batches:
                rows = []
                for k, f, i, v in b.itertuples(index=False, name=None):
                    if (hit := seen.get((f, v))) is None:
                        if len(seen) > 100_000:  # a cache, not a limit
                            seen.clear()
                        hit = seen[f, v] = whole[f].find(v, budget) if f in whole else []
                    rows += [(f, k, i, v, *label, cost) for cost, label in hit]
                yield pd.DataFrame(rows, columns=["field", key, "item_no", "value", "label_id", "label", "cost"])

        part = values.mapInPandas(run, schema)
        out = part if out is None else out.unionAll(part)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


def unify(df: DataFrame, labels: DataFrame, key: str, scalars: list[str], lists: list[str], block: int = BLOCK) -> DataFrame:
    """(key, field, item_no, value, unified, label_id): each value in its one consistent form.

    A value that reads like a label gets the label (the one of the least id, if several read so). Of others,
    each token that reads like a word of a label gets that word's spelling (the least, if several read so), any other the spelling by table. Blank values become empty.
    Labels of more than one block are matched block by block, with the different values and tokens only, whose best matches are joined back.
    """
    tries = list(_tries(df.sparkSession, labels, block))
    values = field_values(spread(df.select(*{key, *scalars, *lists})), key, scalars, lists)
    if len(tries) > 1:
        return _unify_in_blocks(values, tries, key)
    known = tries[0] if tries else df.sparkSession.sparkContext.broadcast(({}, {}))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, words = known.value
        cache: dict = {}

        def form(f: str, v: str) -> tuple:
            if f in whole and (hit := whole[f].find(v)):
                label_id, label = min(x for _, x in hit)
                return label, label_id
            out = []
            for token in glyphs(v).split(" "):
                hit = words[f].find(token) if f in words and token else []
                out.append(min(w for _, w in hit) if hit else spell(token))
            return " ".join(out), None

        for b in batches:
            got = []
            for f, v in zip(b["field"], b["value"], strict=True):
                if (f, v) not in cache:
                    if len(cache) > 100_000:
                        cache.clear()
                    cache[f, v] = form(f, v)
                got.append(cache[f, v])
            b["unified"] = [x[0] for x in got]
            b["label_id"] = pd.array([x[1] for x in got], dtype="Int64")
            yield b

    return values.mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, field string, item_no int, value string, unified string, label_id bigint")


def _unify_in_blocks(values: DataFrame, tries: list, key: str) -> DataFrame:
    """The same for labels of several blocks."""
    different = values.select("field", "value").distinct().persist(StorageLevel.MEMORY_AND_DISK)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(f, v, i, t, spell(t)) for f, v in zip(b["field"], b["value"], strict=True) for i, t in enumerate(glyphs(v).split(" "))]
            yield pd.DataFrame(rows, columns=["field", "value", "i", "token", "spelled"])

    tokens = different.mapInPandas(cut, "field string, value string, i int, token string, spelled string").persist(StorageLevel.MEMORY_AND_DISK)
    wholes, words_ = [], []
    for known in tries:

        def match(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(f, v, *x) for f, v in zip(b["field"], b["value"], strict=True) if f in known.value[0] for _, x in known.value[0][f].find(v)]
                yield pd.DataFrame(rows, columns=["field", "value", "label_id", "label"])

        def spelled(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(f, t, w) for f, t in zip(b["field"], b["token"], strict=True) if t and f in known.value[1] for _, w in known.value[1][f].find(t)]
                yield pd.DataFrame(rows, columns=["field", "token", "word"])

        wholes.append(different.mapInPandas(match, "field string, value string, label_id bigint, label string"))
        words_.append(tokens.select("field", "token").distinct().mapInPandas(spelled, "field string, token string, word string"))
    whole = reduce(DataFrame.unionAll, wholes).groupBy("field", "value").agg(F.min(F.struct("label_id", "label")).alias("hit"))
    word = reduce(DataFrame.unionAll, words_).groupBy("field", "token").agg(F.min("word").alias("word"))
    parts = tokens.join(word, ["field", "token"], "left").groupBy("field", "value").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("word", "spelled").alias("w")))).alias("parts"))
    forms = parts.join(whole, ["field", "value"], "left").select("field", "value", F.coalesce("hit.label", F.array_join(F.transform("parts", lambda x: x["w"]), " ")).alias("unified"), F.col("hit.label_id").alias("label_id"))
    return values.join(forms, ["field", "value"]).select(key, "field", "item_no", "value", "unified", "label_id")


def near_labels(df: DataFrame, labels: DataFrame, scalars: list[str], lists: list[str], budget: float = 1.0, block: int = BLOCK) -> DataFrame:
    """(field, value, label_id, cost): of the different values that read like no label, those that the automaton brings to one within the budget. Rows have them by field and value."""
    key = "field"
    values = field_values(spread(df.select(*scalars, *lists).withColumn("_k", F.lit(0))), "_k", scalars, lists).select("field", "value").distinct()
    out = None
    for known in _tries(df.sparkSession, labels, block):

        def run(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(f, v, label_id, cost) for f, v in zip(b[key], b["value"], strict=True) if f in known.value[0] for cost, (label_id, _) in known.value[0][f].find(v, budget)]
                yield pd.DataFrame(rows, columns=["field", "value", "label_id", "cost"])

        part = values.mapInPandas(run, "field string, value string, label_id bigint, cost double")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "field string, value string, label_id bigint, cost double")
    read = out.groupBy("field", "value").agg(F.min("cost").alias("least"), F.collect_list(F.struct("label_id", "cost")).alias("hits")).where("least > 0")
    return read.select("field", "value", F.inline("hits"))


def same_reading(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(field, row_id, label_id), once each: the row holds a value that reads like the label but isn't the same string.

    Repeats of a value in one list stand in one output row, as the tasks that made them meet in a hash aggregate.
    """
    hit = match_labels(df, labels, "row_id", ["display_name"], ["strategies", "keywords"])
    return hit.where("value != label").select("field", "row_id", "label_id").distinct()
