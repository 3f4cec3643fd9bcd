"""Class membership and two-hop keyword queries, one or many at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import identity, identity_text
from .graph import Graph

RESULT = ["name", "display_name", "nation", "tier", "matched_strategies"]


class ValueNotFound(Exception):
    """No node of that label; carries up to 16 labels that exist."""

    code, exit_code = "query_value_not_found", 4

    def __init__(self, kind: str, value: str, available: list[str]):
        self.kind, self.value, self.normalized, self.available = kind, value, identity_text(value), available
        super().__init__(f"{kind} {value!r} not found; for example: {', '.join(available)}")


def result_order(df: DataFrame) -> DataFrame:
    """Total order: display name, then name, each by identity first; then nation and tier."""
    return df.orderBy(identity(F.col("display_name")), "display_name", identity(F.col("name")), "name", "nation", "tier")


def labels(graph: Graph, kind: str) -> DataFrame:
    """(label, identity) of the classes or keywords of the graph."""
    return graph.nodes.where(F.col("kind") == {"class": "Class", "keyword": "Keyword"}[kind]).select("label", identity(F.col("label")).alias("identity"))


def available(graph: Graph, kind: str, most: int = 16) -> DataFrame:
    """The first labels in sort order: a top-k."""
    return labels(graph, kind).orderBy("identity", "label").limit(most).select("label")


def require(graph: Graph, kind: str, value: str) -> list[str]:
    """The labels that a value looks up, or ValueNotFound. A value that exists but matches no vehicle is no error."""
    key = identity_text(value)
    hit = [r.label for r in labels(graph, kind).where(F.col("identity") == key).limit(2).collect()]
    if not hit:
        raise ValueNotFound(kind, value, [r.label for r in available(graph, kind).collect()])
    return hit


def _tanks(graph: Graph) -> DataFrame:
    return graph.nodes.where("kind = 'Tank'").select(F.col("label").alias("name"), "display_name", "nation", "tier")


def members_of(graph: Graph, wanted: list[str]) -> DataFrame:
    """(class, name, display_name, nation, tier): the vehicles directly in each wanted class; classes above or below don't count.

    Only edges of one type are read, with the wanted classes as a filter that reaches the scan.
    """
    into = graph.of("IsAClassOf").where(F.col("dst").isin(wanted)).select(F.col("dst").alias("class"), F.col("src").alias("name"))
    return into.join(_tanks(graph), "name").select("class", "name", "display_name", "nation", "tier")


def hops(graph: Graph, wanted: list[str]) -> DataFrame:
    """(keyword, name, strategy) on the ways from a wanted keyword back to a vehicle.

    A strategy has the keywords of every record that uses it, so a vehicle is found whose own record lacks the keyword. The wanted
    keywords filter the scan of their edges; AQE splits a strategy that many vehicles share.
    """
    associated = graph.of("AssociatedWithKeyword").where(F.col("dst").isin(wanted)).select(F.col("dst").alias("keyword"), F.col("src").alias("strategy"))
    recommended = graph.of("RecommendedTactic").select(F.col("src").alias("name"), F.col("dst").alias("strategy"))
    return associated.join(recommended, "strategy").select("keyword", "name", "strategy")


def tanks_for(graph: Graph, wanted: list[str]) -> DataFrame:
    """(keyword, name, display_name, nation, tier, matched_strategies): vehicles recommended a strategy that is associated with the keyword; strategies in the order of their text."""
    matched = hops(graph, wanted).groupBy("keyword", "name").agg(F.array_sort(F.collect_set("strategy")).alias("matched_strategies"))
    return matched.join(_tanks(graph), "name").select("keyword", "name", "display_name", "nation", "tier", "matched_strategies")


def query_class(graph: Graph, value: str) -> DataFrame:
    """Ordered result of one class query, with empty matched_strategies."""
    found = members_of(graph, require(graph, "class", value)).select("name", "display_name", "nation", "tier").distinct()
    return result_order(found.withColumn("matched_strategies", F.array().cast("array<string>")))


def query_keyword(graph: Graph, value: str) -> DataFrame:
    """Ordered result of one keyword query; strategies in sort order, each spelling once."""
    found = hops(graph, require(graph, "keyword", value)).select("name", "strategy").distinct()
    grouped = found.withColumn("key", identity(F.col("strategy"))).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("key", "strategy"))).alias("m"))
    return result_order(grouped.join(_tanks(graph), "name").select("name", "display_name", "nation", "tier", F.transform("m", lambda x: x["strategy"]).alias("matched_strategies")))


def not_own(graph: Graph, wanted: list[str], records: DataFrame) -> DataFrame:
    """(keyword, name): vehicles found for a keyword that their own record doesn't have."""
    own = records.select("name", F.explode("keywords").alias("keyword"))
    return hops(graph, wanted).select("keyword", "name").distinct().join(own, ["keyword", "name"], "left_anti")
