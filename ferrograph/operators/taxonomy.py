"""Category members to paths, pages and class evidence."""

from __future__ import annotations

from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import category_leaf, is_organizational, nation_from_category, primary_class, subclass, tier_from_category, wiki_title

#: Most steps of the recursion that enumerates paths. Depths and evidence don't enumerate paths and have no such limit.
DEPTH = 100


def grow(start: DataFrame, step) -> DataFrame:
    """All rows that ``step`` reaches from ``start``, breadth first: each round takes what the last one found first. Rows are distinct, so a cycle ends.

    With a checkpoint folder each round is written there, so that the plan doesn't grow with the depth.
    """
    shared = start.sparkSession.sparkContext.getCheckpointDir() is not None
    keep = (lambda df: df.checkpoint()) if shared else (lambda df: df.persist(StorageLevel.MEMORY_AND_DISK))
    reached = fresh = keep(start.distinct())
    while fresh.head(1):
        fresh = keep(step(fresh).distinct().join(reached, start.columns, "left_anti"))
        reached = reached.unionByName(fresh)
    return reached


def is_subcategory(members: DataFrame) -> Column:
    """By the stated type, where there is one, or the namespace."""
    typed = F.col("type") == "subcat" if "type" in members.columns else F.lit(False)
    return F.coalesce(typed, F.lit(False)) | F.coalesce(F.col("ns") == 14, F.lit(False))


def links(members: DataFrame) -> DataFrame:
    """(parent, child) between categories, distinct, by normalized title."""
    return members.where(is_subcategory(members)).select(wiki_title(F.col("category")).alias("parent"), wiki_title(F.col("title")).alias("child")).where("parent is not null and child is not null").distinct()


def paths(members: DataFrame, root: str) -> DataFrame:
    """(category, path, depth): all paths without repeats from the root to each category, however many they are. A cycle ends where it would repeat."""
    spark, name = members.sparkSession, uuid4().hex
    known, top = f"links_{name}", f"root_{name}"
    links(members).createOrReplaceTempView(known)
    spark.range(1).select(wiki_title(F.lit(root)).alias("category")).createOrReplaceTempView(top)
    try:
        return spark.sql(f"""
        WITH RECURSIVE walk(category, path, depth) MAX RECURSION LEVEL {DEPTH} AS (
          SELECT category, array(category), 0 FROM {top}
          UNION ALL
          SELECT l.child, array_append(w.path, l.child), w.depth + 1
          FROM walk w JOIN {known} l ON l.parent = w.category
          WHERE NOT array_contains(w.path, l.child))
        SELECT category, path, depth FROM walk""")
    finally:  # the plan holds the views' plans
        spark.catalog.dropTempView(known)
        spark.catalog.dropTempView(top)


def closure(members: DataFrame, root: str) -> DataFrame:
    """(category, depth): every category below the root at its least depth. A frontier meets the links once a level and leaves out what was reached before."""
    own = links(members).persist(StorageLevel.MEMORY_AND_DISK)
    fresh = members.sparkSession.range(1).select(wiki_title(F.lit(root)).alias("category"), F.lit(0).alias("depth")).persist()
    reached = fresh
    while fresh.head(1):
        below = fresh.join(own, fresh["category"] == own["parent"]).select(F.col("child").alias("category"), (F.col("depth") + 1).alias("depth")).distinct()
        fresh = below.join(reached.select("category"), "category", "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        reached = reached.unionByName(fresh)
    return reached


def above(members: DataFrame, root: str) -> DataFrame:
    """(category, above): of each category below the root itself and what lies on its ways from the root; ways don't lead through the category itself, nor above the root.

    Pairs are grown upwards and then kept from the root downwards, so paths are never enumerated: at most one row a category and ancestor.
    """
    own = links(members).persist(StorageLevel.MEMORY_AND_DISK)
    below = closure(members, root).select("category").persist(StorageLevel.MEMORY_AND_DISK)
    top = wiki_title(F.lit(root))
    inside = own.join(below.withColumnRenamed("category", "parent"), "parent", "left_semi")
    parent = inside.select(F.col("child").alias("at"), F.col("parent").alias("next")).persist(StorageLevel.MEMORY_AND_DISK)

    def up(fresh: DataFrame) -> DataFrame:
        return fresh.where(F.col("above") != top).join(parent, fresh["above"] == parent["at"]).select("category", F.col("next").alias("above")).where("above != category")

    first = parent.select(F.col("at").alias("category"), F.col("next").alias("above")).where("above != category")
    pairs = grow(first, up)

    def down(fresh: DataFrame) -> DataFrame:
        under = fresh.join(parent, fresh["above"] == parent["next"]).select("category", F.col("at").alias("above"))
        return under.join(pairs, ["category", "above"], "left_semi")

    kept = grow(pairs.where(F.col("above") == top), down)
    return kept.unionByName(below.select("category", F.col("category").alias("above"))).distinct()


def pages(members: DataFrame) -> DataFrame:
    """(page_id, title, categories): one row a page. Members of one id are one page under its least title; one without id joins the page of its title, or is a page of its own.

    A title that several ids have joins the least of them.
    """
    own = members.where(~is_subcategory(members)).select(F.col("title").alias("raw"), wiki_title(F.col("title")).alias("key"), "page_id", wiki_title(F.col("category")).alias("category")).where("key is not null")
    ids = own.where("page_id is not null").groupBy("key").agg(F.min("page_id").alias("known"))
    full = own.join(ids, "key", "left").withColumn("page_id", F.coalesce("page_id", "known"))
    by = full.groupBy("page_id", F.when(F.col("page_id").isNull(), F.col("key")).alias("_alone"))
    # titles are compared as they sort; their key is the identity
    least = F.min_by("key", F.struct("key", "raw"))
    return by.agg(least.alias("title"), F.array_sort(F.collect_set("category")).alias("categories")).select("title", "page_id", "categories")


def evidence(members: DataFrame, root: str) -> DataFrame:
    """(title, page_id, categories, classes, subclasses, nations, tiers): what a page's categories, and those above them, say of it; sets sorted. Categories outside the root's count by themselves."""
    ways = above(members, root)
    unfolded = pages(members).select("title", "page_id", "categories", F.explode("categories").alias("category"))
    all_ = unfolded.join(ways, "category", "left").select("title", "page_id", "categories", F.explode(F.array_distinct(F.array("category", F.coalesce("above", "category")))).alias("category")).distinct()
    c = F.col("category")
    told = all_.select("title", "page_id", "categories", primary_class(c).alias("class"), subclass(c).alias("subclass"), nation_from_category(c).alias("nation"), tier_from_category(c).alias("tier"))
    sets = [F.array_sort(F.collect_set(x)).alias(y) for x, y in (("class", "classes"), ("subclass", "subclasses"), ("nation", "nations"), ("tier", "tiers"))]
    return told.groupBy("title", "page_id", "categories").agg(*sets)


def resolve_class(classes: Column, given: Column, infobox_class: Column) -> tuple[Column, Column, Column]:
    """(class, code, warning) as columns from the classes that categories tell, and the infobox's text and its class.

    Categories that contradict each other, an infobox text that is no class, or one that contradicts the categories reject; one side alone is
    accepted with a warning; none is missing.
    """
    n = F.size(classes)
    one = F.element_at(classes, 1)
    code = (
        F.when(n > 1, F.lit("contradictory_taxonomy_classes"))
        .when(given.isNotNull() & infobox_class.isNull(), F.lit("unknown_infobox_class"))
        .when((n == 1) & infobox_class.isNotNull() & (infobox_class != one), F.lit("primary_class_conflict"))
        .when((n == 0) & infobox_class.isNull(), F.lit("missing_primary_class"))
    )
    warning = F.when(code.isNull() & (n == 0), F.lit("missing_taxonomy_class_evidence")).when(code.isNull() & infobox_class.isNull(), F.lit("infobox_class_fallback"))
    return F.when(code.isNull(), F.coalesce(infobox_class, F.when(n == 1, one))), code, warning


def only(values: Column, missing: str, contradictory: str) -> tuple[Column, Column]:
    """(value, code): the one value of a set; a code if it has none or several."""
    n = F.size(values)
    return F.when(n == 1, F.element_at(values, 1)), F.when(n > 1, F.lit(contradictory)).when(n == 0, F.lit(missing))


def content_categories(members: DataFrame) -> DataFrame:
    """(leaf): categories that aren't only there to organize others."""
    c = F.col("category")
    return members.where(~is_organizational(c)).select(category_leaf(c).alias("leaf")).where("leaf is not null").distinct()
