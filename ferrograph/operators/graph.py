"""Records to a typed graph held as node and edge tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import identity

EDGE = "struct<src_kind:string,src:string,etype:string,dst_kind:string,dst:string>"
#: Which kinds an edge may join.
LEGAL = {"IsAClassOf": ("Tank", "Class"), "IsSubclassOf": ("Class", "Class"), "RecommendedTactic": ("Tank", "Strategy"), "AssociatedWithKeyword": ("Strategy", "Keyword")}


class GraphError(Exception):
    """A graph that can't be built; ``code`` is stable."""

    exit_code = 6

    def __init__(self, code: str, message: str, **context):
        super().__init__(message)
        self.code, self.context = code, context
        if code.endswith("budget_exceeded") or code == "arithmetic_overflow":
            self.exit_code = 5


@dataclass(frozen=True)
class Budgets:
    nodes: int = 2_000_000
    edges: int = 5_000_000
    relationships: int = 5_000_000


@dataclass(frozen=True)
class Graph:
    """Nodes, and edges held by type so that a traversal reads one type only."""

    nodes: DataFrame
    by_type: dict[str, DataFrame]

    @property
    def edges(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.by_type.values())

    def of(self, etype: str) -> DataFrame:
        return self.by_type[etype]

    def unpersist(self) -> None:
        for df in (self.nodes, *self.by_type.values()):
            df.unpersist()


def _edge(src_kind: str, src: Column, etype: str, dst_kind: str, dst: Column) -> Column:
    return F.struct(F.lit(src_kind).alias("src_kind"), src.alias("src"), F.lit(etype).alias("etype"), F.lit(dst_kind).alias("dst_kind"), dst.alias("dst"))


def edges_of_row() -> Column:
    """The edges of a record as a list of structs; strategies and keywords meet inside their row, without a join."""
    name, cls = F.col("name"), F.col("class")
    none = F.array().cast(f"array<{EDGE}>")
    return F.concat(
        F.when(cls.isNotNull(), F.array(_edge("Tank", name, "IsAClassOf", "Class", cls))).otherwise(none),
        F.transform("subclasses", lambda s: _edge("Tank", name, "IsAClassOf", "Class", s)),
        F.when(cls.isNotNull(), F.transform("subclasses", lambda s: _edge("Class", s, "IsSubclassOf", "Class", cls))).otherwise(none),
        F.transform("strategies", lambda s: _edge("Tank", name, "RecommendedTactic", "Strategy", s)),
        F.flatten(F.transform("strategies", lambda s: F.transform("keywords", lambda k: _edge("Strategy", s, "AssociatedWithKeyword", "Keyword", k)))),
    )


def attempted_edges(records: DataFrame) -> DataFrame:
    """Every edge a record asks for, repeats included."""
    return records.select(F.inline(edges_of_row()))


def graph_edges(records: DataFrame) -> DataFrame:
    """Distinct edges; repeats fall away in each task before the shuffle."""
    return attempted_edges(records).distinct()


def graph_nodes(records: DataFrame) -> DataFrame:
    """(kind, label, display_name, nation, tier): vehicles with their attributes, and each class, strategy and keyword that an edge touches.

    Taken from the lists of the records, not from their edges, so no pairs are made for it.
    """
    node = lambda kind, label: F.struct(F.lit(kind).alias("kind"), label.alias("label"))
    used = F.concat(
        F.when(F.col("class").isNotNull(), F.array(node("Class", F.col("class")))).otherwise(F.array().cast("array<struct<kind:string,label:string>>")),
        F.transform("subclasses", lambda s: node("Class", s)),
        F.transform("strategies", lambda s: node("Strategy", s)),
        F.when(F.size("strategies") > 0, F.transform("keywords", lambda k: node("Keyword", k))).otherwise(F.array().cast("array<struct<kind:string,label:string>>")),
    )
    others = records.select(F.inline(used)).distinct()
    tanks = records.select(F.lit("Tank").alias("kind"), F.col("name").alias("label"), "display_name", "nation", "tier")
    return tanks.unionByName(others, allowMissingColumns=True)


def estimates(records: DataFrame) -> DataFrame:
    """(name, nodes, relationships): upper bounds of what each record adds."""
    c, s, k = (F.size(x).cast("long") for x in ("subclasses", "strategies", "keywords"))
    return records.select("name", (2 + c + s + k).alias("nodes"), (1 + 2 * c + s + s * k).alias("relationships"))


def budget_breach(records: DataFrame, budgets: Budgets = Budgets(), parts: int = 16) -> DataFrame:
    """(name, which, running): the first record, by name, whose running total exceeds a budget; nodes are looked at first. No row if none does.

    Running totals are made in name ranges, each offset by the sum of the ranges before it.
    """
    est = estimates(records).repartitionByRange(parts, "name").withColumn("_p", F.spark_partition_id())
    sums = est.groupBy("_p").agg(F.sum("nodes").alias("n"), F.sum("relationships").alias("r"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sums.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("_p").orderBy("name").rowsBetween(Window.unboundedPreceding, 0)
    run = est.join(F.broadcast(offsets), "_p").select("name", (F.col("n0") + F.sum("nodes").over(inside)).alias("nodes"), (F.col("r0") + F.sum("relationships").over(inside)).alias("relationships"))
    over = F.when(F.col("nodes") > budgets.nodes, F.struct(F.lit("nodes").alias("which"), F.col("nodes").alias("running"))).when(
        F.col("relationships") > budgets.relationships, F.struct(F.lit("relationships").alias("which"), F.col("relationships").alias("running"))
    )
    return run.withColumn("o", over).where("o is not null").agg(F.min_by(F.struct("name", "o"), "name").alias("x")).where("x is not null").select("x.name", "x.o.which", "x.o.running")


def graph_stats(records: DataFrame) -> DataFrame:
    """(metric, value): records, nodes of each kind, edges of each type, and suppressed repeats."""
    nodes = graph_nodes(records).groupBy(F.concat(F.lit("nodes:"), "kind").alias("metric")).agg(F.count("*").alias("value"))
    counted = attempted_edges(records).groupBy("src_kind", "src", "etype", "dst_kind", "dst").agg(F.count("*").alias("n"))
    per_type = counted.groupBy("etype").agg(F.count("*").alias("edges"), F.sum(F.col("n") - 1).alias("again"))
    edges = per_type.select(F.explode(F.array(F.struct(F.concat(F.lit("edges:"), "etype").alias("metric"), F.col("edges").alias("value")), F.struct(F.concat(F.lit("suppressed:"), "etype").alias("metric"), F.col("again").alias("value")))).alias("x")).select("x.*")
    return nodes.unionAll(edges).unionAll(records.agg(F.lit("records").alias("metric"), F.count("*").alias("value")))


def lookup_collisions(nodes: DataFrame) -> DataFrame:
    """(kind, identity, labels): class and keyword labels that differ but look up alike."""
    looked = nodes.where(F.col("kind").isin("Class", "Keyword")).select("kind", identity(F.col("label")).alias("identity"), "label")
    return looked.groupBy("kind", "identity").agg(F.array_sort(F.collect_set("label")).alias("labels")).where(F.size("labels") > 1)


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, label) of strategies no vehicle recommends and keywords no strategy has."""
    reached = edges.where(F.col("etype").isin("RecommendedTactic", "AssociatedWithKeyword")).select(F.col("dst_kind").alias("kind"), F.col("dst").alias("label"))
    return nodes.where(F.col("kind").isin("Strategy", "Keyword")).select("kind", "label").join(reached, ["kind", "label"], "left_anti")


def primary_class_counts(edges: DataFrame) -> DataFrame:
    """(name, primaries): how many primary classes each vehicle is in."""
    return edges.where("etype = 'IsAClassOf'").groupBy(F.col("src").alias("name")).agg(F.count_if(F.col("dst").isin(vocab.PRIMARY_CLASSES)).alias("primaries"))


def invariant_breaks(nodes: DataFrame, edges: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:
    """(rule, subject): everything wrong with a graph; no rows for a sound one. Each rule is an aggregate or an anti join of its own."""
    kinds = ["Tank", "Class", "Strategy", "Keyword"]
    legal = reduce(lambda a, b: a | b, [(F.col("etype") == t) & (F.col("src_kind") == x) & (F.col("dst_kind") == y) for t, (x, y) in LEGAL.items()])
    arrow, place = F.concat_ws(" -> ", "src", "etype", "dst"), F.concat_ws(":", "kind", "label")
    told = lambda df, rule, subject: df.select(F.lit(rule).alias("rule"), subject.alias("subject"))
    end = lambda side: edges.select(F.col(f"{side}_kind").alias("kind"), F.col(side).alias("label")).distinct().join(nodes, ["kind", "label"], "left_anti")
    into = lambda kind, etype: nodes.where(F.col("kind") == kind).join(edges.where(F.col("etype") == etype).select(F.col("dst").alias("label")), "label", "left_anti")
    tanks = nodes.where("kind = 'Tank'").select(F.col("label").alias("name")).distinct()
    primaries = tanks.join(primary_class_counts(edges), "name", "left").where(F.coalesce("primaries", F.lit(0)) != 1)
    number = lambda df: df.agg(F.count("*").alias("n"))
    parts = [
        told(nodes.where(~F.coalesce(F.col("kind").isin(kinds), F.lit(False)) | F.col("label").isNull()), "node of no kind", F.coalesce(place, F.lit(""))),
        told(nodes.groupBy("kind", "label").agg(F.count("*").alias("n")).where("n > 1"), "repeated node", place),
        told(edges.groupBy("src_kind", "src", "etype", "dst_kind", "dst").agg(F.count("*").alias("n")).where("n > 1"), "repeated edge", arrow),
        told(end("src"), "edge without source", place),
        told(end("dst"), "edge without target", place),
        told(edges.where(~F.coalesce(legal, F.lit(False))), "illegal edge", arrow),
        told(edges.where((F.col("etype") == "IsSubclassOf") & F.col("src").isin(vocab.PRIMARY_CLASSES)), "subclass is a primary class", arrow),
        told(primaries, "not one primary class", F.col("name")),
        told(into("Strategy", "RecommendedTactic"), "strategy of no vehicle", F.col("label")),
        told(into("Keyword", "AssociatedWithKeyword"), "keyword of no strategy", F.col("label")),
        told(lookup_collisions(nodes), "labels look up alike", F.concat_ws(":", "kind", "identity")),
        told(number(nodes).where(F.col("n") > budgets.nodes), "node budget", F.col("n").cast("string")),
        told(number(edges).where(F.col("n") > budgets.edges), "edge budget", F.col("n").cast("string")),
    ]
    return reduce(DataFrame.unionAll, parts)


def typed_edges(records: DataFrame) -> dict[str, DataFrame]:
    """Distinct edges of each type."""
    all_ = graph_edges(records)
    return {t: all_.where(F.col("etype") == t) for t in LEGAL}


def build_graph(records: DataFrame, budgets: Budgets = Budgets(), check: bool = True) -> Graph:
    """The graph of valid records, made and kept on the executors, or a GraphError.

    Budgets are checked on estimates before any edge is made, and on the nodes and edges there are afterwards; then lookups and invariants. Edges of a type lie sorted by
    target, so that a lookup skips the cached blocks that can't hold it.
    """
    if check and (breach := budget_breach(records, budgets).head()):
        which = "node" if breach.which == "nodes" else "relationship"
        raise GraphError(f"{which}_budget_exceeded", f"{breach.running} {breach.which} at {breach.name}", record=breach.name, running=breach.running)
    kept = lambda df, *by: df.sortWithinPartitions(*by).persist(StorageLevel.MEMORY_AND_DISK)
    graph = Graph(kept(graph_nodes(records), "kind", "label"), {t: kept(e, "dst") for t, e in typed_edges(records).items()})
    n_nodes, n_edges = graph.nodes.count(), sum(e.count() for e in graph.by_type.values())
    if check:
        for n, most, which in ((n_nodes, budgets.nodes, "node"), (n_edges, budgets.edges, "edge")):
            if n > most:
                raise GraphError(f"{which}_budget_exceeded", f"{n} {which}s, {most} are allowed", running=n)
        if bad := lookup_collisions(graph.nodes).head():
            raise GraphError("lookup_key_collision", f"{bad.kind} labels {list(bad.labels)} look up alike", labels=list(bad.labels))
    return graph


def validated(graph: Graph, budgets: Budgets = Budgets()) -> Graph:
    """The graph, or a GraphError that names a broken invariant."""
    if bad := invariant_breaks(graph.nodes, graph.edges, budgets).head():
        raise GraphError("invariant_failure", f"{bad.rule}: {bad.subject}", rule=bad.rule)
    return graph


def write_graph(graph: Graph, to: str) -> None:
    """Nodes by kind and edges by type, sorted by target, so that a query reads one type's files and skips their row groups."""
    graph.nodes.sortWithinPartitions("label").write.mode("overwrite").partitionBy("kind").parquet(f"{to}/nodes")
    edges = graph.edges
    edges.repartitionByRange("etype", "dst").sortWithinPartitions("etype", "dst").write.mode("overwrite").partitionBy("etype").parquet(f"{to}/edges")


def read_graph(spark: SparkSession, path: str) -> Graph:
    """A graph that was written; nothing is read before a query asks."""
    edges = spark.read.parquet(f"{path}/edges").select("src_kind", "src", "etype", "dst_kind", "dst")
    return Graph(spark.read.parquet(f"{path}/nodes"), {t: edges.where(F.col("etype") == t) for t in LEGAL})
