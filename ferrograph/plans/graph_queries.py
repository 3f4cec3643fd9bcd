"""Queries of records, contract and graph, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import assemble, graph, query, records
from ..sources import read_table
from .unicode_sql import SPACES, identity_ctes

WANTED_KEYWORDS = ["sidescraping", "hull-down", "weak spot", "view range"]
COLUMNS = ["row_id", "name", "display_name", "class", "subclasses", "nation", "tier", "strategies", "keywords", "extracted_at", "loaded_at"]
BUDGETS = graph.Budgets(nodes=1_000, relationships=2_000)
INVARIANT_BUDGETS = graph.Budgets(nodes=1_500, edges=4_000)


def _records(spark, sf_dir):
    return records.latest_records(read_table(spark, sf_dir, "tanks_data", *COLUMNS))


_GRAPHS: dict = {}


def _graph(spark, sf_dir):
    """The graph of a directory, built once a session and kept on the executors for all queries over it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GRAPHS:
        _GRAPHS[key] = graph.build_graph(_records(spark, sf_dir), check=False)
    return _GRAPHS[key]


def _join(df, *cols):
    """Lists as text, for comparison."""
    for c in cols:
        df = df.withColumn(c, F.array_join(c, "|"))
    return df


def records_latest(spark, sf_dir):
    return _join(_records(spark, sf_dir), *records.LISTS)


def first_kept(spark, sf_dir):
    return records.first_kept(read_table(spark, sf_dir, "tanks_data", "row_id", "name"))


def violation_rows(spark, sf_dir):
    return records.violations(read_table(spark, sf_dir, "tanks_data", *COLUMNS))


def violation_counts(spark, sf_dir):
    return violation_rows(spark, sf_dir).groupBy("field", "message").agg(F.count("*").alias("n"))


def violations_topk(spark, sf_dir):
    return records.violation_report(violation_rows(spark, sf_dir))


def record_order_breaks(spark, sf_dir):
    return records.order_breaks(read_table(spark, sf_dir, "tanks_data", "row_id", "name"), "name", "row_id")


def first_occurrence_duplicates(spark, sf_dir):
    return records.first_occurrences(read_table(spark, sf_dir, "tanks_data", "row_id", "name"), "name", "row_id")


def graph_edges(spark, sf_dir):
    return graph.graph_edges(_records(spark, sf_dir))


def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(_records(spark, sf_dir))


def graph_stats(spark, sf_dir):
    return graph.graph_stats(_records(spark, sf_dir))


def estimate_totals(spark, sf_dir):
    return graph.estimates(_records(spark, sf_dir)).agg(F.sum("nodes").alias("nodes"), F.sum("relationships").alias("relationships"))


def budget_first_breach(spark, sf_dir):
    return graph.budget_breach(_records(spark, sf_dir), BUDGETS)


def lookup_collisions(spark, sf_dir):
    return graph.lookup_collisions(graph.graph_nodes(_records(spark, sf_dir)))


def invariant_breaks(spark, sf_dir):
    g = _graph(spark, sf_dir)
    return graph.invariant_breaks(g.nodes, g.edges, INVARIANT_BUDGETS)


def primary_class_cardinality(spark, sf_dir):
    return graph.primary_class_counts(graph.graph_edges(_records(spark, sf_dir)))


def orphan_nodes(spark, sf_dir):
    r = _records(spark, sf_dir)
    return graph.orphans(graph.graph_nodes(r), graph.graph_edges(r))


def class_members(spark, sf_dir):
    return query.members_of(_graph(spark, sf_dir), ["Heavy Tanks"]).drop("class")


def class_members_batch(spark, sf_dir):
    return query.members_of(_graph(spark, sf_dir), vocab.PRIMARY_CLASSES)


def keyword_two_hop(spark, sf_dir):
    return _join(query.tanks_for(_graph(spark, sf_dir), ["sidescraping"]), "matched_strategies").drop("keyword")


def keyword_batch(spark, sf_dir):
    return _join(query.tanks_for(_graph(spark, sf_dir), WANTED_KEYWORDS), "matched_strategies")


def keyword_not_own_record(spark, sf_dir):
    return query.not_own(_graph(spark, sf_dir), WANTED_KEYWORDS, _records(spark, sf_dir))


def available_classes_top16(spark, sf_dir):
    return query.available(_graph(spark, sf_dir), "class")


def duplicate_names(spark, sf_dir):
    return assemble.duplicate_identities(read_table(spark, sf_dir, "tanks_data", "name"), "name")


def sorted_unique_keywords(spark, sf_dir):
    return assemble.sorted_unique(read_table(spark, sf_dir, "tanks_data", "row_id", "keywords"), "row_id", "keywords")


def run_summary(spark, sf_dir):
    r = _records(spark, sf_dir)
    size = lambda c: F.sum(F.size(c)).alias(c)
    return r.agg(F.count("*").alias("records"), size("subclasses"), size("strategies"), size("keywords"), F.count_if(F.size("strategies") == 0).alias("without_strategies"))


_Q = (
    records_latest, first_kept, violation_rows, violation_counts, violations_topk, record_order_breaks, first_occurrence_duplicates, graph_edges, graph_nodes, graph_stats,
    estimate_totals, budget_first_breach, lookup_collisions, invariant_breaks, primary_class_cardinality, orphan_nodes, class_members, class_members_batch, keyword_two_hop, keyword_batch,
    keyword_not_own_record, available_classes_top16, duplicate_names, sorted_unique_keywords, run_summary,
)
QUERIES = {f.__name__: f for f in _Q}


def _clean(c: str) -> str:
    return rf"coalesce(list_sort(list_distinct([x FOR x IN {c} IF x IS NOT NULL AND regexp_matches(x, '[^ \t\r\n]')])), [])"


_RECORDS = rf"""
WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY extracted_at DESC NULLS LAST, loaded_at DESC NULLS LAST, row_id DESC) AS rn FROM tanks_data WHERE name IS NOT NULL) WHERE rn = 1),
r AS (SELECT name, display_name, class, {_clean("subclasses")} AS subclasses, nation, tier, {_clean("strategies")} AS strategies, {_clean("keywords")} AS keywords FROM latest)
"""
_EDGES = (
    _RECORDS
    + """,
attempts AS (
  SELECT 'Tank' AS src_kind, name AS src, 'IsAClassOf' AS etype, 'Class' AS dst_kind, class AS dst FROM r WHERE class IS NOT NULL
  UNION ALL SELECT 'Tank', name, 'IsAClassOf', 'Class', unnest(subclasses) FROM r
  UNION ALL SELECT 'Class', unnest(subclasses), 'IsSubclassOf', 'Class', class FROM r WHERE class IS NOT NULL
  UNION ALL SELECT 'Tank', name, 'RecommendedTactic', 'Strategy', unnest(strategies) FROM r
  UNION ALL SELECT 'Strategy', s, 'AssociatedWithKeyword', 'Keyword', unnest(keywords) FROM (SELECT unnest(strategies) AS s, keywords FROM r)),
edges AS (SELECT DISTINCT * FROM attempts),
nodes AS (
  SELECT 'Tank' AS kind, name AS label, display_name, nation, tier FROM r
  UNION ALL SELECT DISTINCT dst_kind, dst, NULL, NULL, NULL FROM edges
  UNION ALL SELECT DISTINCT 'Class', src, NULL, NULL, NULL FROM edges WHERE src_kind = 'Class' AND src NOT IN (SELECT dst FROM edges WHERE dst_kind = 'Class'))
"""
)
_CLASS_SET = ", ".join(f"'{x}'" for x in vocab.PRIMARY_CLASSES)
_MEMBERS = _RECORDS + f", u AS (SELECT name, display_name, nation, tier, unnest(list_distinct(list_append(subclasses, class))) AS class FROM r) SELECT class, name, display_name, nation, tier FROM u WHERE class IN ({_CLASS_SET})"
_WANTED = ", ".join(f"'{x}'" for x in WANTED_KEYWORDS)
_HOPS = (
    _EDGES
    + f""",
hits AS (SELECT DISTINCT a.dst AS keyword, t.src AS name, t.dst AS strategy FROM edges a JOIN edges t ON t.etype = 'RecommendedTactic' AND t.dst = a.src WHERE a.etype = 'AssociatedWithKeyword' AND a.dst IN ({_WANTED})),
two AS (SELECT keyword, r.name, r.display_name, r.nation, r.tier, string_agg(strategy, '|' ORDER BY strategy) AS matched_strategies FROM hits JOIN r ON r.name = hits.name GROUP BY ALL)
"""
)


_ROW_TEXTS = " UNION ALL ".join(f"SELECT {x} AS v FROM tanks_data" for x in ("display_name", "nation", "unnest(subclasses)", "unnest(strategies)", "unnest(keywords)"))
_NAMES = "SELECT name AS v FROM tanks_data"


def _rules(v: str, most: int, keyword: bool = False) -> list[tuple[str, int, str]]:
    blank = f"NOT regexp_matches({v}, '[^{SPACES[1:-1]}]')"
    out = [
        (blank, 1, "is blank"),
        (f"regexp_matches({v}, '(^{SPACES})|({SPACES}$)') AND NOT ({blank})", 2, "has outer spaces"),
        (f"{v} != t.canonical", 3, "is not in canonical form"),
        (f"length({v}) > {most}", 4, f"is longer than {most}"),
        (rf"regexp_matches({v}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}]')", 5, "has control characters"),
        (rf"regexp_matches({v}, '`|\[\[|\]\]|\{{\{{|\}}\}}|<[A-Za-z/!?]')", 8, "has markup"),
    ]
    if keyword:
        out += [(f"regexp_matches({v}, '[\\r\\n\\t]')", 6, "has several lines or tabs"), (f"{v} != t.folded", 7, "is not in small letters")]
    return out


def _violations() -> str:
    limits = records.Limits()
    parts = []

    def add(test: str, field: str, rule: int, message: str, item: str = "NULL::INT", source: str = "tanks_data") -> None:
        told = message if message.startswith("'") else f"'{message}'"
        parts.append(f"SELECT row_id, '{field}' AS field, {item} AS item, {rule} AS rule, {told} AS message FROM {source} WHERE {test}")

    for f in records.FIELDS:
        add(f'"{f}" IS NULL', f, 0, "is missing")
    add("NOT regexp_full_match(name, '[A-Za-z0-9][A-Za-z0-9_.-]*')", "name", 9, "is no identifier")
    add(f"length(name) > {limits.label}", "name", 4, f"is longer than {limits.label}")
    for f in ("display_name", "nation"):
        for t, n, m in _rules(f, limits.label):
            add(t, f, n, m, source=f"tanks_data JOIN ids t ON t.v = {f}")
    add(f"class NOT IN ({_CLASS_SET})", "class", 10, "is no primary class")
    add("tier NOT BETWEEN 1 AND 10", "tier", 11, "is not between 1 and 10")
    add("len(keywords) > 0 AND coalesce(len(strategies), 0) = 0", "keywords", 12, "need strategies")
    tables = [f"v_ids AS (SELECT 1), {identity_ctes(_ROW_TEXTS)}"]
    for f, most, size in (("subclasses", limits.subclasses, limits.label), ("strategies", limits.strategies, limits.strategy), ("keywords", limits.keywords, limits.label)):
        add(f"len({f}) > {most}", f, 13, f"has more than {most} items")
        tables.append(f"""{f}_i AS (SELECT row_id, unnest({f}) AS v, generate_subscripts({f}, 1) - 1 AS i FROM tanks_data WHERE len({f}) > 0),
          {f}_t AS (SELECT x.*, t.canonical, t.folded, t.identity, CASE WHEN t.identity IS NOT NULL THEN min(i) OVER (PARTITION BY row_id, t.identity) END AS first,
            lag(x.v) OVER w AS before, lag(t.identity) OVER w AS before_id FROM {f}_i x LEFT JOIN ids t ON t.v = x.v WINDOW w AS (PARTITION BY row_id ORDER BY i))""")
        rules = [("v IS NULL", 0, "is missing"), *_rules("v", size, f == "keywords"), ("first < i", 15, "'is the same as item ' || first"), ("i > 0 AND NOT (before_id < identity OR (before_id = identity AND before < v))", 18, "is not sorted")]
        if f == "subclasses":
            rules.append((f"identity IN ({', '.join(repr(x.lower()) for x in vocab.PRIMARY_CLASSES)})", 14, "is a primary class"))
        for t, n, m in rules:
            add(t, f, n, m, "i::INT", f"{f}_t t")
    return "WITH " + ", ".join(tables) + ", v AS (" + "\nUNION ALL ".join(parts) + ") "


_VIOLATIONS = _violations()
_NAME_IDS = "WITH " + identity_ctes(_NAMES)
_LABEL_IDS = _EDGES + ", " + identity_ctes("SELECT label AS v FROM nodes WHERE kind IN ('Class', 'Keyword')")
_COLLISIONS = "SELECT kind, identity, list_sort(list(DISTINCT label)) AS labels FROM nodes JOIN ids ON v = label WHERE kind IN ('Class', 'Keyword') GROUP BY kind, identity HAVING count(DISTINCT label) > 1"
ORACLES = {
    "records_latest": _RECORDS + "SELECT name, display_name, class, array_to_string(subclasses, '|') AS subclasses, nation, tier, array_to_string(strategies, '|') AS strategies, array_to_string(keywords, '|') AS keywords FROM r",
    "first_kept": _NAME_IDS + "SELECT identity, arg_min(name, row_id) AS name, min(row_id) AS row_id, count(*) - 1 AS dropped, count(DISTINCT name) AS spellings FROM tanks_data JOIN ids ON v = name GROUP BY identity",
    "violation_rows": _VIOLATIONS + "SELECT * FROM v",
    "violation_counts": _VIOLATIONS + "SELECT field, message, count(*) AS n FROM v GROUP BY ALL",
    "violations_topk": _VIOLATIONS + "SELECT * FROM v ORDER BY row_id, field, item NULLS FIRST, rule, message LIMIT 32",
    "record_order_breaks": _NAME_IDS + "SELECT row_id, name, previous FROM (SELECT row_id, name, identity, lag(name) OVER w AS previous, lag(identity) OVER w AS before FROM tanks_data JOIN ids ON v = name WINDOW w AS (ORDER BY row_id)) WHERE before > identity OR (before = identity AND previous >= name)",
    "first_occurrence_duplicates": _NAME_IDS + "SELECT row_id, name, first FROM (SELECT row_id, name, min(row_id) OVER (PARTITION BY identity) AS first FROM tanks_data JOIN ids ON v = name) WHERE row_id > first",
    "duplicate_names": _NAME_IDS + "SELECT identity, list_sort(list(DISTINCT name)) AS spellings FROM tanks_data JOIN ids ON v = name GROUP BY identity HAVING count(*) > 1",
    "sorted_unique_keywords": "WITH " + identity_ctes("SELECT unnest(keywords) AS v FROM tanks_data")
    + """, k AS (SELECT row_id, identity, min(x.v) AS w FROM (SELECT row_id, unnest(keywords) AS v FROM tanks_data) x JOIN ids ON ids.v = x.v GROUP BY row_id, identity)
      SELECT t.row_id, coalesce(keywords, []) AS keywords FROM tanks_data t LEFT JOIN (SELECT row_id, list(w ORDER BY identity) AS keywords FROM k GROUP BY row_id) l USING (row_id)""".replace("SELECT t.row_id, coalesce(keywords, [])", "SELECT t.row_id, coalesce(l.keywords, [])"),
    "lookup_collisions": _LABEL_IDS + _COLLISIONS,
    "available_classes_top16": _LABEL_IDS + "SELECT label FROM (SELECT label, identity FROM nodes JOIN ids ON v = label WHERE kind = 'Class' ORDER BY identity, label LIMIT 16)",
    "graph_edges": _EDGES + "SELECT * FROM edges",
    "graph_nodes": _EDGES + "SELECT * FROM nodes",
    "graph_stats": _EDGES
    + """SELECT 'nodes:' || kind AS metric, count(*) AS value FROM nodes GROUP BY kind
      UNION ALL SELECT 'edges:' || etype, count(*) FROM edges GROUP BY etype
      UNION ALL SELECT 'suppressed:' || etype, count(*) - (SELECT count(*) FROM edges e WHERE e.etype = a.etype) FROM attempts a GROUP BY etype
      UNION ALL SELECT 'records', count(*) FROM r""",
    "estimate_totals": _RECORDS + "SELECT sum(2 + len(subclasses) + len(strategies) + len(keywords))::BIGINT AS nodes, sum(1 + 2 * len(subclasses) + len(strategies) + len(strategies) * len(keywords))::BIGINT AS relationships FROM r",
    "budget_first_breach": _RECORDS
    + f""", t AS (SELECT name, sum(2 + len(subclasses) + len(strategies) + len(keywords)) OVER w AS nodes, sum(1 + 2 * len(subclasses) + len(strategies) + len(strategies) * len(keywords)) OVER w AS relationships
      FROM r WINDOW w AS (ORDER BY name ROWS UNBOUNDED PRECEDING))
      SELECT name, CASE WHEN nodes > {BUDGETS.nodes} THEN 'nodes' ELSE 'relationships' END AS which, (CASE WHEN nodes > {BUDGETS.nodes} THEN nodes ELSE relationships END)::BIGINT AS running
      FROM t WHERE nodes > {BUDGETS.nodes} OR relationships > {BUDGETS.relationships} ORDER BY name LIMIT 1""",
    "primary_class_cardinality": _EDGES + f"SELECT src AS name, count(*) FILTER (WHERE dst IN ({_CLASS_SET})) AS primaries FROM edges WHERE etype = 'IsAClassOf' GROUP BY src",
    "orphan_nodes": _EDGES + "SELECT kind, label FROM nodes n WHERE kind IN ('Strategy', 'Keyword') AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.dst_kind = n.kind AND e.dst = n.label AND e.etype IN ('RecommendedTactic', 'AssociatedWithKeyword'))",
    "invariant_breaks": _LABEL_IDS
    + f""", breaks AS (
      SELECT 'repeated node' AS rule, kind || ':' || label AS subject FROM nodes GROUP BY kind, label HAVING count(*) > 1
      UNION ALL SELECT 'repeated edge', src || ' -> ' || etype || ' -> ' || dst FROM edges GROUP BY ALL HAVING count(*) > 1
      UNION ALL SELECT DISTINCT 'edge without source', src_kind || ':' || src FROM edges e WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.kind = e.src_kind AND n.label = e.src)
      UNION ALL SELECT DISTINCT 'edge without target', dst_kind || ':' || dst FROM edges e WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.kind = e.dst_kind AND n.label = e.dst)
      UNION ALL SELECT 'illegal edge', src || ' -> ' || etype || ' -> ' || dst FROM edges WHERE (etype, src_kind, dst_kind) NOT IN (('IsAClassOf', 'Tank', 'Class'), ('IsSubclassOf', 'Class', 'Class'), ('RecommendedTactic', 'Tank', 'Strategy'), ('AssociatedWithKeyword', 'Strategy', 'Keyword'))
      UNION ALL SELECT 'subclass is a primary class', src || ' -> ' || etype || ' -> ' || dst FROM edges WHERE etype = 'IsSubclassOf' AND src IN ({_CLASS_SET})
      UNION ALL SELECT 'not one primary class', name FROM (SELECT DISTINCT label AS name FROM nodes WHERE kind = 'Tank') LEFT JOIN (SELECT src, count(*) FILTER (WHERE dst IN ({_CLASS_SET})) AS n FROM edges WHERE etype = 'IsAClassOf' GROUP BY src) ON src = name WHERE coalesce(n, 0) != 1
      UNION ALL SELECT 'strategy of no vehicle', label FROM nodes WHERE kind = 'Strategy' AND label NOT IN (SELECT dst FROM edges WHERE etype = 'RecommendedTactic')
      UNION ALL SELECT 'keyword of no strategy', label FROM nodes WHERE kind = 'Keyword' AND label NOT IN (SELECT dst FROM edges WHERE etype = 'AssociatedWithKeyword')
      UNION ALL SELECT 'labels look up alike', kind || ':' || identity FROM ({_COLLISIONS})
      UNION ALL SELECT 'node budget', n::VARCHAR FROM (SELECT count(*) AS n FROM nodes) WHERE n > {INVARIANT_BUDGETS.nodes}
      UNION ALL SELECT 'edge budget', n::VARCHAR FROM (SELECT count(*) AS n FROM edges) WHERE n > {INVARIANT_BUDGETS.edges}) SELECT * FROM breaks""",
    "class_members": "SELECT name, display_name, nation, tier FROM (" + _MEMBERS + ") WHERE class = 'Heavy Tanks'",
    "class_members_batch": _MEMBERS,
    "keyword_two_hop": _HOPS + "SELECT name, display_name, nation, tier, matched_strategies FROM two WHERE keyword = 'sidescraping'",
    "keyword_batch": _HOPS + "SELECT * FROM two",
    "keyword_not_own_record": _HOPS + "SELECT keyword, two.name FROM two JOIN r ON r.name = two.name WHERE NOT list_contains(r.keywords, keyword)",
    "run_summary": _RECORDS + "SELECT count(*) AS records, sum(len(subclasses))::BIGINT AS subclasses, sum(len(strategies))::BIGINT AS strategies, sum(len(keywords))::BIGINT AS keywords, count(*) FILTER (WHERE len(strategies) = 0) AS without_strategies FROM r",
}
