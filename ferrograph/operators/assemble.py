"""Vehicles and sources of statements to publishable records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import identity, sorted_unique_strings
from .prose import concepts, deduplicated, extract_concepts, is_tactical, statements

_KEPT = ("rank", "ord", "block_no", "sentence_no")


def wiki_sources(vehicles: DataFrame) -> DataFrame:
    """(name, text, source_kind, ord, applicable_classes) of the sections of wiki pages, in order."""
    one = vehicles.where("status = 'accepted'").select("name", F.posexplode("sections").alias("ord", "s"))
    return one.select("name", F.col("s.text").alias("text"), F.lit("wiki").alias("source_kind"), F.col("ord").cast("bigint").alias("ord"), F.array().cast("array<string>").alias("applicable_classes"))


def guide_sources(guides: DataFrame) -> DataFrame:
    """(name null, text, source_kind, ord, applicable_classes, tactical_concepts) of guide segments that apply to some class."""
    none = F.lit(None).cast("string").alias("name")
    rows = guides.where("text is not null and size(applicable_classes) > 0")
    return rows.select(none, "text", "source_kind", F.xxhash64("url", "pos").alias("ord"), "applicable_classes", "tactical_concepts")


def assemble(vehicles: DataFrame, sources: DataFrame, extractor=concepts) -> DataFrame:
    """Records of ``vehicles`` (name, display_name, class, subclasses, nation, tier) with the statements of ``sources``
    (name or null, applicable_classes, source_kind, text, ord) that are theirs or apply to their class.

    Statements are deduplicated by identity within a vehicle: the best source rank, then the first position, keeps its spelling. Those of a class are deduplicated
    once for the class and join its vehicles as one row, so pairs of statements and vehicles are only made inside the records that hold them.
    Keywords are the concepts of the kept statements, distinct by identity. A vehicle without statements has empty lists. ``extractor`` makes the concepts.
    """
    given = ["tactical_concepts"] if "tactical_concepts" in sources.columns else []
    cut = statements(sources.where("text is not null"), "text", "name", "applicable_classes", "source_kind", "ord", *given).where(is_tactical(F.col("statement")))
    item = F.struct("identity", *_KEPT, "statement", "concepts")

    def gathered(rows: DataFrame, by: str) -> DataFrame:
        best = deduplicated(rows, list(_KEPT[1:]), (by,))
        told = extract_concepts(best, "statement", extractor, given[0] if given else None)
        return told.groupBy(by).agg(F.collect_list(item).alias("items"))

    own = gathered(cut.where("name is not null").drop("applicable_classes"), "name")
    scoped = gathered(cut.where("name is null").drop("name").withColumn("class", F.explode(F.array_distinct("applicable_classes"))).drop("applicable_classes"), "class")
    met = vehicles.join(own, "name", "left").join(scoped.withColumnRenamed("items", "general"), "class", "left")
    none = F.array().cast(own.schema["items"].dataType.simpleString())
    merged = met.withColumn("items", F.array_sort(F.concat(F.coalesce("items", none), F.coalesce("general", none)))).drop("general")
    first = F.filter("items", lambda x, i: (i == 0) | (F.get("items", i - 1)["identity"] != x["identity"]))
    lists = merged.withColumn("items", first)
    return lists.select(
        "name", "display_name", "class", "subclasses", "nation", "tier", F.transform("items", lambda x: x["statement"]).alias("strategies"),
        F.coalesce(sorted_unique_strings(F.flatten(F.transform("items", lambda x: x["concepts"]))), F.array().cast("array<string>")).alias("keywords"),
    )


def duplicate_identities(df: DataFrame, c: str) -> DataFrame:
    """(identity, spellings): values whose identity several rows have."""
    return df.where(F.col(c).isNotNull()).select(identity(F.col(c)).alias("identity"), c).groupBy("identity").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(c)).alias("spellings")).where("n > 1").drop("n")


def sorted_unique(df: DataFrame, key: str, values: str) -> DataFrame:
    """(key, values): distinct by identity, the least spelling of each, in sort order; folded inside the row. Null and empty lists become empty."""
    return df.select(key, F.coalesce(sorted_unique_strings(F.col(values)), F.array().cast("array<string>")).alias(values))
