import pytest
from pyspark.sql import functions as F

from ferrograph.operators import guides, records, wiki
from ferrograph.sources.config import Config, ConfigError, nation_filter, url_path

GOOD = {"api": "https://w.example/api.php", "guide_root": "https://g.example/guides/", "contact": "bot (me@x.example)", "root_category": "Category:R"}


def test_config():
    c = Config(**GOOD)
    assert [c.classify(u) for u in ("https://w.example/api.php?x=1", "https://g.example/guides/a/../b", "https://g.example/other", "https://g.example/robots.txt", "http://w.example/api.php", "https://g.example/guides/%2e%2e/x")] == [
        "wiki", "guide", None, "robots", None, None,
    ]
    for change in ({"api": "http://w.example/"}, {"api": "https://u:p@w.example/"}, {"contact": "me"}, {"root_category": " "}, {"attempts": 6}, {"interval": 1}, {"contact": "a@b.c\nX"}):
        with pytest.raises(ConfigError):
            Config(**GOOD | change)
    with pytest.raises(ConfigError):
        url_path("https://h/a%5cb")


def test_config_of_flags_and_environment():
    env = {f"FERROGRAPH_{k.upper()}": v for k, v in GOOD.items()} | {"FERROGRAPH_ATTEMPTS": "2", "FERROGRAPH_NATIONS": "UK, USSR"}
    c = Config.of({"root_category": "Category:X", "api": None, "nations": ()}, env)
    assert (c.root_category, c.api, c.attempts, c.nations) == ("Category:X", GOOD["api"], 2, ("UK", "USSR"))
    assert Config.of(GOOD) == Config(**GOOD)
    for given, environment in (({}, {}), (GOOD, {"FERROGRAPH_ATTEMPTS": "x"})):
        with pytest.raises(ConfigError):
            Config.of(given, environment)


def test_nation_filter(spark):
    df = spark.createDataFrame([("USSR",), ("UK",), (None,)], "n string")
    assert [df.where(nation_filter(F.col("n"), x)).count() for x in ((), ("ALL",), ("UK",))] == [3, 3, 1]


def test_children(spark):
    page = '<a href="b/?utm_x=1">b</a><a href="https://other.example/guides/c/">c</a><a href="/guides/d/#x">d</a><a>e</a><a href="http://[x">f</a><a href="z">g</a>'
    pages = spark.createDataFrame([(1, "https://g.example/guides/", page), (2, None, None)], "fetch_id bigint, url string, body string")
    allowed = spark.createDataFrame([(f"https://g.example/guides/{x}",) for x in ("d/", "b/", "y/", "d/")] + [(None,)], "url string")
    got = guides.discover_children(pages, allowed, "https://g.example/guides/")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "https://g.example/guides/b/"), (1, "https://g.example/guides/d/")]
    assert guides.discover_children(pages, allowed.limit(0), "https://g.example/guides/").count() == 0


def test_redirects(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(60)]
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("in", "x"), ("s", "s"), (None, "q"), *chain], "source string, target string")
    got = {r.source: (r.target, r.code) for r in wiki.redirect_targets(df).collect()}
    cycle = (None, "redirect_cycle")
    assert {k: v for k, v in got.items() if k[0] != "n"} == {"a": ("c", None), "b": ("c", None), "x": cycle, "y": cycle, "in": cycle, "s": cycle}
    assert all(got[f"n{i}"] == ("n60", None) for i in range(60))
    assert wiki.redirect_targets(df.limit(0)).count() == 0
    body = '{"query":{"redirects":[{"from":"Old_x","to":"New x"}],"normalized":[{"from":"a_b","to":"a b"}]}}'
    told = wiki.redirects(spark.createDataFrame([(body,), (None,), ("{",)], "body string"))
    assert sorted(tuple(r) for r in told.collect()) == [("a b", "a b"), ("old x", "new x")]


def test_evidence(spark):
    df = spark.createDataFrame([(["Category:A", "B"], ["b", None, "C"]), (None, ["Tank_articles"]), (None, None)], "a array<string>, b array<string>")
    assert [r.e for r in df.select(wiki.ordered_evidence(F.col("a"), F.col("b")).alias("e")).collect()] == [["Category:A", "B", "C"], ["Tank_articles"], []]


BOX = "{{Infobox vehicle|%s}}"
VEHICLES = {
    "plain": ("Tank:A b", BOX % "class=TD|nation=german|tier=7", ("accepted", None, "A_b", "Tank Destroyers", "Germany", 7)),
    "own id first": ("Tank:A", BOX % "id=X1|class=TD|nation=german|tier=7", ("accepted", None, "X1", "Tank Destroyers", "Germany", 7)),
    "bad id": ("Tank:A", BOX % "id=X 1|class=TD|nation=german|tier=7", ("accepted", None, "A", "Tank Destroyers", "Germany", 7)),
    "nested": ("Tank:A", "{{Wrap|" + BOX % "class=TD|nation=german|tier=7" + "}}", ("accepted", None, "A", "Tank Destroyers", "Germany", 7)),
    "no box": ("Tank:A", "text", ("non_vehicle", "non_vehicle_candidate")),
    "two boxes": ("Tank:A", BOX % "tier=1" + BOX % "tier=1", ("rejected", "competing_vehicle_infoboxes")),
    "conflict": ("Tank:A", BOX % "nation=german|country=usa", ("rejected", "conflicting_infobox_parameters")),
    "no name": ("A", BOX % "class=TD", ("rejected", "missing_vehicle_identifier")),
    "bad name": ("Tank:Ä", BOX % "class=TD", ("rejected", "invalid_vehicle_identifier")),
    "two classes": ("Tank:A", BOX % "class=TD" + "[[Category:SPGs]][[Category:Heavy tanks]]", ("rejected", "contradictory_taxonomy_classes")),
    "unknown class": ("Tank:A", BOX % "class=boat", ("rejected", "unknown_infobox_class")),
    "other class": ("Tank:A", BOX % "class=TD" + "[[Category:SPGs]]", ("rejected", "primary_class_conflict")),
    "no class": ("Tank:A", BOX % "nation=usa|tier=1", ("rejected", "missing_primary_class")),
    "stub": ("Tank:A", BOX % "tier=1" + "[[Category:Tank articles requiring maintenance]]", ("non_vehicle", "incomplete_vehicle_page")),
    "unknown nation": ("Tank:A", BOX % "class=TD|nation=Mars|tier=1", ("rejected", "unknown_nation")),
    "no nation": ("Tank:A", BOX % "class=TD|tier=1", ("rejected", "missing_nation")),
    "two nations": ("Tank:A", BOX % "class=TD|tier=1" + "[[Category:German tanks]][[Category:USA]]", ("rejected", "contradictory_taxonomy_nations")),
    "no tier": ("Tank:A", BOX % "class=TD|nation=usa", ("rejected", "missing_tier")),
    "two tiers": ("Tank:A", BOX % "class=TD|nation=usa" + "[[Category:Tier I tanks]][[Category:Tier 2]]", ("rejected", "contradictory_taxonomy_tiers")),
    "bad tier": ("Tank:A", BOX % "class=TD|nation=usa|tier=11", ("rejected", "invalid_tier")),
    "word tier": ("Tank:A", BOX % "class=TD|nation=usa|tier=VII", ("rejected", "invalid_tier")),
    "inferred": ("Tank:A", BOX % "display name=Big" + "[[Category:SPGs]][[Category:German tanks]][[Category:Tier VII tanks]]", ("accepted", None, "A", "SPGs", "Germany", 7)),
}


def test_vehicle_rules(spark):
    rows = [(i, t, x, None, None, []) for i, (t, x, _) in enumerate(VEHICLES.values())] + [(99, None, None, "api_error", None, [])]
    revs = spark.createDataFrame(rows, "fetch_id bigint, title string, text string, code string, display_title string, categories array<string>")
    got = {r.fetch_id: r for r in wiki.vehicles(revs).collect()}
    for i, (case, (_, _, want)) in enumerate(VEHICLES.items()):
        r = got[i]
        assert (r.status, r.code, r.name, r["class"], r.nation, r.tier)[: len(want)] == want, case
    assert (got[99].status, got[99].code) == ("rejected", "api_error")
    warned = {case: got[i].warnings for i, case in enumerate(VEHICLES)}
    assert warned["bad id"] == ["invalid_infobox_identifier_fallback", "missing_taxonomy_class_evidence"]
    assert warned["inferred"] == ["infobox_class_fallback", "infobox_nation_fallback", "infobox_tier_fallback"] and warned["no tier"] == []
    assert wiki.vehicles(revs.limit(0)).count() == 0


def test_sections_of_boxes_and_unique_names(spark):
    text = BOX % "class=TD|nation=usa|tier=1|inthegame_tactics=* Hold.<br>* Aim." + "\n== Tactics ==\n{{x}}\n"
    revs = spark.createDataFrame([(i, t, text, None, "''Shown''", ["Category:A"]) for i, t in ((2, "Tank:b"), (1, "Tank:B"), (3, "Tank:C"))], "fetch_id bigint, title string, text string, code string, display_title string, categories array<string>")
    v = wiki.vehicles(revs).orderBy("fetch_id").collect()
    assert v[0].sections[0].title == "Tactics" and "Hold." in v[0].sections[0].text and "empty_tactical_section" in v[0].warnings
    assert {(r.fetch_id, r.kept) for r in wiki.unique_vehicles(wiki.vehicles(revs)).collect()} == {(1, True), (2, False), (3, True)}


def test_producer_rules(fleet):
    assert records.violations(fleet, "name", producer=True).count() == 0
    other = fleet.withColumn("nation", F.lit("Mars")).withColumn("subclasses", F.array(F.lit("Boats")))
    assert records.violations(other, "name").count() == 0 and records.violations(other, "name", producer=True).count() == 6
