"""Snapshots to records, and the contract they must keep."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import identity, sort_key, text_forms

FIELDS = ["name", "display_name", "class", "subclasses", "nation", "tier", "strategies", "keywords"]
LISTS = ["subclasses", "strategies", "keywords"]
NOT_BLANK = r"[^ \t\r\n]"


@dataclass(frozen=True)
class Limits:
    """Bounds of the contract."""

    records: int = 10_000
    subclasses: int = 100
    strategies: int = 1_000
    keywords: int = 1_000
    label: int = 120
    strategy: int = 1_000
    shown: int = 32


def clean_list(c: Column) -> Column:
    """Sorted, distinct, without nulls and blanks; null becomes empty."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull() & x.rlike(NOT_BLANK))))


def latest_records(snapshots: DataFrame) -> DataFrame:
    """One row a name: its latest snapshot by (extracted_at, loaded_at, row_id), lists cleaned; rows without name are left out.

    A hash aggregate keeps the latest of each task before the shuffle, so a name with a tenth of all rows arrives as one row a task.
    """
    row = F.struct(*[F.col(c) for c in FIELDS if c != "name"])
    best = snapshots.where("name is not null").groupBy("name").agg(F.max_by(row, F.struct("extracted_at", "loaded_at", "row_id")).alias("r"))
    cols = [clean_list(F.col(f"r.{c}")).alias(c) if c in LISTS else F.col(f"r.{c}") for c in FIELDS if c != "name"]
    return best.select("name", *cols)


def first_kept(snapshots: DataFrame) -> DataFrame:
    """(identity, name, row_id, dropped, spellings): of each identity of a name its first delivery, how many later ones it stands for and in how many spellings they came."""
    keyed = snapshots.where("name is not null").select(identity(F.col("name")).alias("identity"), "name", "row_id")
    return keyed.groupBy("identity").agg(F.min_by("name", "row_id").alias("name"), F.min("row_id").alias("row_id"), (F.count("*") - 1).alias("dropped"), F.countDistinct("name").alias("spellings"))


SPACES = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CONTROLS = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
MARKUP = r"`|\[\[|\]\]|\{\{|\}\}|<[A-Za-z/!?]"
VIOLATION = "struct<field:string,item:int,rule:int,message:string>"


def _text_rules(v: Column, form: Column, most: int, keyword: bool = False) -> list[tuple[Column, int, str]]:
    """(test, number, message) of the rules of one text; ``form`` holds its canonical form and case fold."""
    blank = ~v.rlike(f"[^{SPACES}]")
    rules = [
        (blank, 1, "is blank"),
        (~blank & v.rlike(f"^[{SPACES}]|[{SPACES}]\\z"), 2, "has outer spaces"),
        (v != form["canonical"], 3, "is not in canonical form"),
        (F.length(v) > most, 4, f"is longer than {most}"),
        (v.rlike(CONTROLS), 5, "has control characters"),
        (v.rlike(MARKUP), 8, "has markup"),
    ]
    if keyword:
        rules += [(v.rlike(r"[\r\n\t]"), 6, "has several lines or tabs"), (v != form["folded"], 7, "is not in small letters")]
    return sorted(rules, key=lambda r: r[1])


def violations(rows: DataFrame, key: str = "row_id", limits: Limits = Limits(), producer: bool = False) -> DataFrame:
    """(key, field, item, rule, message): every rule that a row breaks, item null for whole fields. A producer also keeps to the canonical nations and subclasses.

    Lists are compared by identity: an item with the identity of an earlier one names the first such item, and items must rise strictly by (identity, text).
    All rules are columns of one scan, exploded in the row; nothing is shuffled. Null is a violation, never a default.
    """
    none = F.lit(None).cast("int")

    def found(test: Column, field: str, item: Column, rule: int, message) -> Column:
        told = message if isinstance(message, Column) else F.lit(message)
        return F.when(test, F.struct(F.lit(field).alias("field"), item.alias("item"), F.lit(rule).alias("rule"), told.alias("message")))

    human = ("display_name", "nation")
    # the forms of all texts of a row come from one call: first the single fields, then the lists
    empty = F.array().cast("array<string>")
    texts = F.concat(F.array(*human), *[F.coalesce(F.col(f), empty) for f in LISTS])
    formed = rows.withColumn("_forms", text_forms(texts))
    before = F.lit(len(human))
    checks = [found(F.col(f"`{f}`").isNull(), f, none, 0, "is missing") for f in FIELDS]
    checks.append(found(F.length("name") > limits.label, "name", none, 4, f"is longer than {limits.label}"))
    checks.append(found(~F.col("name").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]*\z"), "name", none, 9, "is no identifier"))
    for i, f in enumerate(human):
        checks += [found(t, f, none, n, m) for t, n, m in _text_rules(F.col(f), F.get("_forms", F.lit(i)), limits.label)]
    checks.append(found(~F.col("class").isin(vocab.PRIMARY_CLASSES), "class", none, 10, "is no primary class"))
    checks.append(found(~F.col("tier").between(1, 10), "tier", none, 11, "is not between 1 and 10"))
    checks.append(found((F.size("keywords") > 0) & (F.coalesce(F.size("strategies"), F.lit(0)) <= 0), "keywords", none, 12, "need strategies"))
    if producer:
        checks.append(found(~F.col("nation").isin(vocab.NATIONS), "nation", none, 16, "is not canonical"))
        checks.append(found(F.exists("subclasses", lambda s: ~s.isin(sorted(set(vocab.SUBCLASS_ALIASES.values())))), "subclasses", none, 17, "are not canonical"))
    lists = [F.array(*checks)]
    primary = [x.casefold() for x in vocab.PRIMARY_CLASSES]
    for f, most, size in (("subclasses", limits.subclasses, limits.label), ("strategies", limits.strategies, limits.strategy), ("keywords", limits.keywords, limits.label)):
        c = F.col(f)
        lists.append(F.array(found(F.size(c) > most, f, none, 13, f"has more than {most} items")))
        own = F.slice("_forms", before + 1, F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)))
        ids = F.transform(own, lambda x: x["identity"])
        before = before + F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))

        def items(f=f, c=c, size=size, own=own, ids=ids) -> Column:
            def one(v: Column, i: Column) -> Column:
                form, last = F.get(own, i), F.get(own, i - 1)
                first = F.array_position(ids, form["identity"]) - 1
                rules = [(v.isNull(), 0, "is missing"), *_text_rules(v, form, size, f == "keywords")]
                if f == "subclasses":
                    rules.append((form["identity"].isin(primary), 14, "is a primary class"))
                rules.append((first < i, 15, F.concat(F.lit("is the same as item "), first.cast("string"))))
                rising = (last["identity"] < form["identity"]) | ((last["identity"] == form["identity"]) & (F.get(c, i - 1) < v))
                rules.append(((i > 0) & ~rising, 18, "is not sorted"))
                return F.array(*[found(t, f, i.cast("int"), n, m) for t, n, m in rules])

            return F.coalesce(F.flatten(F.transform(c, one)), F.array().cast(f"array<{VIOLATION}>"))

        lists.append(items())
    broken = F.filter(F.concat(*lists), lambda x: x.isNotNull())
    return formed.select(F.col(f"`{key}`").alias(key), F.inline(broken))


def violation_report(found: DataFrame, key: str = "row_id", shown: int = 32) -> DataFrame:
    """The first ``shown`` violations by (record, field, item, rule): a top-k, taken in every task before one merges them."""
    return found.orderBy(F.col(key).asc_nulls_first(), F.col("field"), F.col("item").asc_nulls_first(), F.col("rule"), F.col("message")).limit(shown)


def order_breaks(rows: DataFrame, value: str, ordinal: str, parts: int = 16) -> DataFrame:
    """(ordinal, value, previous): rows whose value isn't above the value before them by (identity, value), in the order of ``ordinal``.

    Rows are ranged by ordinal, each range compares its own rows, and the first of a range is compared with the last of the nearest
    range before that has any; so no task holds more than its range. Null values are skipped.
    """
    from pyspark.sql import Window

    keyed = rows.where(F.col(value).isNotNull()).select(F.col(ordinal).alias("ordinal"), sort_key(F.col(value)).alias("key"))
    ranged = keyed.repartitionByRange(parts, "ordinal").withColumn("_p", F.spark_partition_id())
    inside = Window.partitionBy("_p").orderBy("ordinal")
    lagged = ranged.withColumn("before", F.lag("key").over(inside))
    edges = ranged.groupBy("_p").agg(F.max_by("key", "ordinal").alias("last"))  # one row a range
    after = edges.select((F.lead("_p").over(Window.orderBy("_p"))).alias("_p"), F.col("last"))
    joined = lagged.join(F.broadcast(after.where("_p is not null")), "_p", "left")
    full = joined.withColumn("before", F.coalesce("before", "last"))
    return full.where(F.col("before") >= F.col("key")).select(F.col("ordinal").alias(ordinal), F.col("key.value").alias(value), F.col("before.value").alias("previous"))


def first_occurrences(rows: DataFrame, value: str, ordinal: str, salts: int = 16, hot: int = 100_000) -> DataFrame:
    """(ordinal, value, first): rows whose value has the identity of an earlier row's, with the first such row. Null values are skipped.

    The firsts are one row an identity, found by a combining minimum. An identity of more than ``hot`` rows meets its first in ``salts`` buckets, all others in one.
    """
    keyed = rows.where(F.col(value).isNotNull()).select(F.col(ordinal).alias("ordinal"), F.col(value).alias("value"), identity(F.col(value)).alias("identity"))
    firsts = keyed.groupBy("identity").agg(F.min("ordinal").alias("first"), F.count("*").alias("n")).where("n > 1")
    bucket = F.pmod(F.xxhash64("ordinal"), F.lit(salts)).cast("int")
    spread_ = firsts.select("identity", "first", (F.col("n") > hot).alias("hot"))
    dealt = spread_.select("identity", "first", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("bucket"))
    often = F.broadcast(spread_.where("hot").select("identity", "hot"))  # at most all rows / hot
    salted = keyed.join(often, "identity", "left").select("ordinal", "value", "identity", F.when(F.col("hot"), bucket).otherwise(F.lit(0)).alias("bucket"))
    met = salted.join(dealt, ["identity", "bucket"])
    return met.where(F.col("ordinal") > F.col("first")).select(F.col("ordinal").alias(ordinal), F.col("value").alias(value), "first")
