import pytest
from pyspark.sql import functions as F

from ferrograph.operators import graph, query, records

TIGER = [("T1", "Tiger", "Heavy Tanks", [], "Germany", 7, ["s1", "s2"], ["k1", "k2", "k3", "k4"])]
SCHEMA = "name string, display_name string, class string, subclasses array<string>, nation string, tier int, strategies array<string>, keywords array<string>"


def test_one_vehicle_counts(spark):
    r = spark.createDataFrame(TIGER, SCHEMA)
    assert graph.graph_nodes(r).count() == 8 and graph.graph_edges(r).count() == 11
    assert graph.estimates(r).collect()[0][1:] == (8, 11)


def test_shared_nodes_and_suppressed(fleet):
    stats = {r.metric: r.value for r in graph.graph_stats(fleet).collect()}
    assert stats["nodes:Strategy"] == 3 and stats["nodes:Keyword"] == 3 and stats["nodes:Tank"] == 3 and stats["records"] == 3
    assert stats["edges:IsSubclassOf"] == 2 and stats["suppressed:AssociatedWithKeyword"] == 0


@pytest.fixture
def built(fleet):
    g = graph.build_graph(fleet)
    yield g
    g.unpersist()


def test_class_query_is_direct_and_ordered(built):
    assert [r.name for r in query.query_class(built, "heavy  tanks").collect()] == ["B01", "A01"]
    assert [r.name for r in query.query_class(built, "AUTOLOADERS").collect()] == ["C01", "A01"]
    assert query.query_class(built, "Light Tanks").collect()[0].matched_strategies == []


def test_keyword_reaches_records_without_it(built, fleet):
    got = {r.name: list(r.matched_strategies) for r in query.query_keyword(built, "hull‐down").collect()}
    assert got == {"A01": ["Angle the hull.", "Hold the ridge."], "B01": ["Hold the ridge."]}
    assert [(r.keyword, r.name) for r in query.not_own(built, ["hull-down"], fleet).collect()] == [("hull-down", "B01")]


def test_not_found_names_what_exists(built):
    with pytest.raises(query.ValueNotFound) as e:
        query.query_keyword(built, "Ｎope")
    assert e.value.available == ["hull-down", "sidescraping", "view range"] and e.value.normalized == "nope" and e.value.exit_code == 4


def test_a_written_graph_answers_the_same(built, spark, tmp_path):
    graph.write_graph(built, str(tmp_path / "g"))
    again = graph.read_graph(spark, str(tmp_path / "g"))
    assert again.nodes.count() == built.nodes.count() and again.edges.exceptAll(built.edges).count() == 0
    assert query.query_keyword(again, "view range").collect() == query.query_keyword(built, "view range").collect()
    plan = again.of("IsAClassOf").where("dst = 'x'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(etype" in plan and "EqualTo(dst,x)" in plan


def test_budget_breach_is_the_first_record(fleet):
    got = graph.budget_breach(fleet, graph.Budgets(nodes=8, relationships=100), parts=2).collect()
    assert [(r.name, r.which, r.running) for r in got] == [("B01", "nodes", 7 + 4)]
    assert graph.budget_breach(fleet).collect() == []
    with pytest.raises(graph.GraphError) as e:
        graph.build_graph(fleet, graph.Budgets(nodes=1))
    assert e.value.code == "node_budget_exceeded" and e.value.exit_code == 5


def test_collision_fails_the_build(spark, fleet):
    other = spark.createDataFrame([("D01", "D", "SPGs", ["AUTOLOADERS"], "UK", 5, ["x"], ["k"])], SCHEMA)
    with pytest.raises(graph.GraphError) as e:
        graph.build_graph(fleet.unionAll(other))
    assert e.value.code == "lookup_key_collision"


def test_sound_graph_has_no_breaks_and_each_corruption_one(spark, fleet):
    nodes, edges = graph.graph_nodes(fleet), graph.graph_edges(fleet)
    assert graph.invariant_breaks(nodes, edges).collect() == []

    def rules(n, e, **budgets):
        return {r.rule for r in graph.invariant_breaks(n, e, graph.Budgets(**budgets)).collect()}

    node = lambda *r: spark.createDataFrame([(*r, None, None, None)], "kind string, label string, display_name string, nation string, tier int")
    edge = lambda *r: spark.createDataFrame([r], "src_kind string, src string, etype string, dst_kind string, dst string")
    assert rules(nodes.unionAll(node("Boat", "x")), edges) == {"node of no kind"}
    assert rules(nodes.unionAll(nodes.where("kind = 'Class'").limit(1)), edges) == {"repeated node"}
    assert rules(nodes, edges.unionAll(edges.where("etype = 'RecommendedTactic'").limit(1))) == {"repeated edge"}
    assert rules(nodes, edges.unionAll(edge("Tank", "lost", "RecommendedTactic", "Strategy", "Scout ahead."))) == {"edge without source"}
    assert rules(nodes.where("label != 'view range'"), edges) == {"edge without target"}
    assert rules(nodes, edges.unionAll(edge("Tank", "A01", "RecommendedTactic", "Class", "Heavy Tanks"))) == {"illegal edge"}
    assert rules(nodes, edges.unionAll(edge("Class", "Heavy Tanks", "IsSubclassOf", "Class", "Light Tanks"))) == {"subclass is a primary class"}
    assert rules(nodes.unionAll(node("Tank", "new")), edges) == {"not one primary class"}
    assert rules(nodes, edges.unionAll(edge("Tank", "A01", "IsAClassOf", "Class", "Light Tanks"))) == {"not one primary class"}
    assert rules(nodes.unionAll(node("Strategy", "x")), edges) == {"strategy of no vehicle"}
    assert rules(nodes.unionAll(node("Keyword", "x")), edges) == {"keyword of no strategy"}
    assert "labels look up alike" in rules(nodes.unionAll(node("Class", "LIGHT tanks")), edges)
    assert rules(nodes, edges, nodes=1) == {"node budget"} and rules(nodes, edges, edges=1) == {"edge budget"}
    with pytest.raises(graph.GraphError, match="repeated edge"):
        twice = graph.Graph(nodes, {"IsAClassOf": edges.unionAll(edges)})
        graph.validated(twice)
    with pytest.raises(graph.GraphError) as e:
        graph.build_graph(fleet, graph.Budgets(edges=3))
    assert e.value.code == "edge_budget_exceeded" and e.value.exit_code == 5


def test_latest_record_and_list_cleaning(spark):
    rows = [(1, "A", ["b", None, " ", "a", "a"], "2024-01-01", "2024-01-01"), (2, "A", None, "2024-01-02", "2024-01-01"), (3, "A", ["z"], "2024-01-02", "2024-01-03"), (4, None, ["q"], "2024-01-09", None)]
    df = spark.createDataFrame([(a, b, "d", "c", [], "n", 1, c, c, d, e) for a, b, c, d, e in rows], "row_id int, " + SCHEMA + ", extracted_at string, loaded_at string")
    got = records.latest_records(df).collect()
    assert [(r.name, r.strategies) for r in got] == [("A", ["z"])]
    assert records.latest_records(df.where("row_id = 1")).collect()[0].keywords == ["a", "b"]
    assert records.latest_records(df.limit(0)).collect() == []
