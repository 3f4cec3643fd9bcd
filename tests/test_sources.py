import json

import pytest
from pyspark.sql import functions as F

from ferrograph import cli
from ferrograph.operators import prose, records, taxonomy, wiki
from ferrograph.plans import benchmark
from ferrograph.sources import admit, fetching, publish
from ferrograph.sources.category_source import CategorySource, members

GOOD = {"name": "A01", "display_name": "Zeta", "class": "Heavy Tanks", "subclasses": [], "nation": "USSR", "tier": 8, "strategies": ["Angle the hull."], "keywords": ["hull-down"]}


def bad(**change):
    return json.dumps([GOOD | change])


@pytest.mark.parametrize(
    "data",
    [
        "{}", "[] []", "[]x", "﻿[]", "[", '[{"name": "a", "name": "b"}]', json.dumps([{**GOOD, "x": 1}]), json.dumps([{k: v for k, v in GOOD.items() if k != "tier"}]),
        bad(tier=None), bad(tier="7"), bad(tier=7.5), bad(tier=True), bad(tier=-1), bad(tier=256), bad(name=None), bad(keywords="x"), bad(keywords=[1]), "[NaN]", "[1]",
    ],
)
def test_strict_decode(data):
    with pytest.raises(admit.IngestError) as e:
        admit.decode(data.encode())
    assert e.value.code == "json_syntax"


def test_bytes(tmp_path):
    with pytest.raises(admit.IngestError) as e:
        admit.decode(b"[\xff]")
    assert e.value.code == "json_syntax"
    for path, code in ((tmp_path / "no", "path_not_found"), (tmp_path, "not_regular_file")):
        with pytest.raises(admit.IngestError) as e:
            admit.read_bounded(str(path), 10)
        assert e.value.code == code
    (tmp_path / "f").write_bytes(b"x" * 11)
    with pytest.raises(admit.IngestError) as e:
        admit.read_bounded(str(tmp_path / "f"), 10)
    assert e.value.code == "file_too_large"


def test_semantics_and_round_trip(spark, fleet, tmp_path):
    to = tmp_path / "out.json"
    n = publish.write_dataset(fleet, str(to))
    assert n == len(to.read_bytes()) and to.read_bytes().endswith(b"]\n")
    again = admit.load_dataset(spark, str(to))
    assert again.records.count() == 3 and again.is_production_success
    before = to.read_bytes()
    with pytest.raises(admit.IngestError):
        publish.write_dataset(fleet.withColumn("tier", F.lit(11)), str(to))
    assert to.read_bytes() == before and len(list(tmp_path.iterdir())) == 1
    for change in ({"tier": 0}, {"class": "Boats"}, {"keywords": ["b", "a"]}, {"keywords": ["a", "a"]}, {"strategies": []}, {"display_name": " x"}, {"display_name": "[[x]]"}, {"strategies": ["x\x07y"]}, {"name": "A 1"}):
        (tmp_path / "bad.json").write_text(bad(**change))
        with pytest.raises(admit.IngestError) as e:
            admit.load_dataset(spark, str(tmp_path / "bad.json"))
        assert e.value.code == "semantic_validation", change
    (tmp_path / "two.json").write_text(json.dumps([GOOD, GOOD | {"name": "a01"}]))
    with pytest.raises(admit.IngestError, match="same"):
        admit.load_dataset(spark, str(tmp_path / "two.json"))
    (tmp_path / "rev.json").write_text(json.dumps([GOOD | {"name": "B"}, GOOD]))
    with pytest.raises(admit.IngestError, match="not sorted"):
        admit.load_dataset(spark, str(tmp_path / "rev.json"))


def test_mixed_case_round_trip(spark, tmp_path):
    """assemble, publish and load agree on order, canonical form and identity."""
    from ferrograph.operators.assemble import assemble

    v = spark.createDataFrame([("Beta", "B", "Heavy Tanks", [], "USSR", 8), ("alpha", "A", "Heavy Tanks", ["Autoloaders"], "USSR", 8)], "name string, display_name string, class string, subclasses array<string>, nation string, tier int")
    s = spark.createDataFrame([(None, ["Heavy Tanks"], "class_guide", "aim at the Gun of the target. Bounce shells with ｈｕｌｌ‑down armor.", 1)], "name string, applicable_classes array<string>, source_kind string, text string, ord int")
    to = str(tmp_path / "r.json")
    publish.write_dataset(assemble(v, s), to, producer=True)
    rows = admit.load_dataset(spark, to).records.orderBy("ordinal").collect()
    assert [r.name for r in rows] == ["alpha", "Beta"]
    assert rows[0].strategies == ["aim at the Gun of the target.", "Bounce shells with hull-down armor."] and "hull-down" in rows[0].keywords


@pytest.mark.parametrize(
    ("change", "told"),
    [
        ({"display_name": "Ａ"}, "display_name is not in canonical form"), ({"strategies": ["STRASSE x.", "Straße x."]}, "strategies[1] is the same as item 0"),
        ({"strategies": ["b.", "A."]}, "strategies[1] is not sorted"), ({"keywords": ["Aim"]}, "keywords[0] is not in small letters"), ({"keywords": ["a\tb"]}, "keywords[0] has several lines or tabs"),
        ({"subclasses": ["HEAVY tanks"]}, "subclasses[0] is a primary class"), ({"strategies": ["a", "a\u00a0"]}, "has outer spaces"), ({"nation": "\u2003"}, "nation is blank"),
    ],
)
def test_rules_of_texts(spark, tmp_path, change, told):
    (tmp_path / "x.json").write_text(bad(**change))
    with pytest.raises(admit.IngestError) as e:
        admit.load_dataset(spark, str(tmp_path / "x.json"))
    assert any(told in x for x in e.value.context["shown"]), e.value.context["shown"]


def test_names_of_one_identity(spark):
    df = spark.createDataFrame([(1, "Tank"), (2, "tank"), (3, "TANK"), (4, "other"), (5, None)], "o bigint, v string")
    for hot in (1, 100):
        assert sorted(tuple(r) for r in records.first_occurrences(df, "v", "o", hot=hot).collect()) == [(2, "tank", 1), (3, "TANK", 1)]
    assert [tuple(r) for r in records.order_breaks(df, "v", "o", 2).orderBy("o").collect()] == [(3, "TANK", "tank"), (4, "other", "TANK")]
    first = records.first_kept(df.withColumnsRenamed({"o": "row_id", "v": "name"})).orderBy("row_id").collect()
    assert [tuple(r) for r in first] == [("tank", "Tank", 1, 2, 3), ("other", "other", 4, 0, 1)]


def test_extraction(spark, tmp_path, capsys):
    members = spark.createDataFrame([("Category:R", 14, 1, "Category:Heavy Tanks"), ("Category:Heavy Tanks", 0, 5, "Tank:A"), ("Category:Heavy Tanks", 0, 6, "Tank:B")], "category string, ns int, page_id bigint, title string")
    page = lambda t, x: json.dumps({"query": {"pages": [{"pageid": 5, "title": t, "revisions": [{"slots": {"main": {"content": x}}}]}]}})
    good = "{{Infobox vehicle|nation=usa|tier=7}}\n== Tactics ==\nHold the ridge and keep your hull armor covered. It is No. 4.5 of all.\n"
    payloads = spark.createDataFrame([(1, "u", page("Tank:A", good)), (2, "u", page("Tank:B", "{{Infobox vehicle|tier=99}}")), (3, "u", page("Tank:a", good))], "fetch_id bigint, url string, body string")
    guide = "<main><h1>Tactics</h1><p>Use cover and keep the hull armor behind it at all times, whatever your vehicle is doing.</p></main>"
    pages = spark.createDataFrame([(1, "https://g.example/guides/a", guide), (2, "https://else.example/", guide)], "fetch_id bigint, url string, body string")
    for name, df in (("m", members), ("p", payloads), ("g", pages)):
        df.write.parquet(str(tmp_path / name))
    args = ["extract", "--members", str(tmp_path / "m"), "--payloads", str(tmp_path / "p"), "--pages", str(tmp_path / "g"), "--output", str(tmp_path / "o.json"), "--api", "https://w.example/api.php", "--guide-root", "https://g.example/guides/", "--contact", "a@b.example", "--root-category", "Category:R", "--format", "json"]
    assert cli.main(args, spark) == 0
    summary = json.loads(capsys.readouterr().out)
    assert {k: summary[k] for k in ("category_count", "candidate_page_count", "accepted_tank_count", "rejected_candidate_count", "guide_page_count", "skipped_guide_count", "strategy_count")} == {
        "category_count": 2, "candidate_page_count": 2, "accepted_tank_count": 1, "rejected_candidate_count": 2, "guide_page_count": 1, "skipped_guide_count": 1, "strategy_count": 3,
    }
    loaded = admit.load_dataset(spark, str(tmp_path / "o.json")).records.collect()
    assert [(r.name, r["class"], r.nation, r.tier) for r in loaded] == [("A", "Heavy Tanks", "USA", 7)]
    assert cli.main([*args, "--nation", "UK"], spark) == 1 and json.loads(capsys.readouterr().err)["error"]["code"] == "extraction"


def test_cli(spark, fleet, tmp_path, capsys):
    path = str(tmp_path / "d.json")
    publish.write_dataset(fleet, path)
    assert cli.main(["query", "class", "--input", path, "--name", "heavy tanks", "--format", "json"], spark) == 0
    assert [r["name"] for r in json.loads(capsys.readouterr().out)["rows"]] == ["B01", "A01"]
    assert cli.main(["query", "keyword", "--input", path, "--name", "none", "--format", "json"], spark) == 4
    assert json.loads(capsys.readouterr().err)["error"]["code"] == "query_value_not_found"
    assert cli.main(["query", "class", "--input", path, "--name", " "], spark) == 2
    assert cli.main(["query", "class", "--input", path + "x", "--name", "a"], spark) == 3
    assert cli.main(["benchmark", "class", "--input", path, "--name", "SPGs"], spark) == 4
    assert cli.main(["benchmark", "class", "--input", path, "--name", "Light Tanks", "--warmup", "0", "--iterations", "2", "--max-p95-us", "0.001"], spark) == 7


def test_statistics():
    assert benchmark.statistics([i * 1000 for i in range(1, 11)]) == benchmark.Statistics(1.0, 5.5, 10.0, 10.0)
    assert benchmark.statistics([i * 1000 for i in range(1, 21)]).p95_us == 19.0
    report = benchmark.run("class", "x", lambda: [1], 0, 4, 1.0, benchmark.FakeClock(1000))
    assert report.statistics.p95_us == 1.0 and not report.passed and report.exit_code == 7 and json.loads(report.to_json())["rows"] == 1


def test_fetching(spark):
    assert [fetching.retry_delay(n) for n in (1, 3, 4, 5)] == [5, 5, 8, 15] and fetching.retry_delay(1, "7") == 7
    assert fetching.retry_delay(1, "Thu, 01 Jan 1970 00:00:30 GMT", now=10) == 20
    with pytest.raises(ValueError, match="loop"):
        fetching.follow("https://h/a", "/b", {"https://h/b"})
    with pytest.raises(ValueError, match="host"):
        fetching.follow("https://h/a", "https://g/", set())
    robots = fetching.Robots(lambda u: (200, "User-agent: *\nDisallow: /private"), "bot")
    assert robots.allows("https://h/x") and not robots.allows("https://h/private/x")
    assert not fetching.Robots(lambda u: (403, ""), "bot").allows("https://h/") and fetching.Robots(lambda u: (404, ""), "bot").allows("https://h/")
    now = [0.0]
    limiter = fetching.Limiter(5, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(2):
        with limiter:
            now[0] += 1
    assert now[0] == 7
    df = spark.createDataFrame([(200, "<main>x"), (200, "captcha"), (404, "gone"), (200, '{"query":1}'), (200, None)], "s int, b string")
    assert [r[0] for r in df.select(fetching.response_kind(F.col("s"), F.col("b"))).collect()] == ["article", "blocked", "error", "api", "empty"]


def test_bounds_and_probe(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"query":{"allpages":[]}}')
    (tmp_path / "b.json").write_text("x" * 100)
    kept, large = fetching.bounded(spark.read.format("binaryFile").load(str(tmp_path)), 50)
    assert kept.select(fetching.is_api_probe(F.col("content").cast("string"))).head()[0] is True and [r.code for r in large.collect()] == ["body_too_large"]
    df = spark.createDataFrame([("{}",), ("[",), (None,)], "b string")
    assert not any(r[0] for r in df.select(fetching.is_api_probe(F.col("b"))).collect())


def test_category_source(spark, tmp_path):
    page = {"query": {"categorymembers": [{"ns": 14, "pageid": 1, "title": "Category:B"}]}, "continue": {"cmcontinue": "t"}}
    (tmp_path / "a.json").write_text(json.dumps({"Category:A": [page, {"query": {"categorymembers": [{"ns": 0, "title": "Tank:X"}]}}]}))
    spark.dataSource.register(CategorySource)
    assert [tuple(r) for r in spark.read.format("category_payloads").load(str(tmp_path)).orderBy("seq").collect()] == [("Category:A", 14, 1, "Category:B", 0), ("Category:A", 0, None, "Tank:X", 1)]
    for pages in ([page, page], [{"error": {"info": "no"}}], [{}]):
        with pytest.raises(ValueError):
            list(members("c", pages))


def test_taxonomy(spark):
    rows = [("Category:R", 14, 1, "Category:Heavy Tanks", 0), ("Category:Heavy Tanks", 14, 2, "Category:German tanks", 0), ("Category:German tanks", 14, 1, "Category:R", 0), ("Category:German_tanks", 0, None, "Tank:T", 1), ("Category:X", 0, 7, "Tank:T", 0)]
    m = spark.createDataFrame(rows, "category string, ns int, page_id bigint, title string, seq int")
    assert {(r.category, r.depth) for r in taxonomy.closure(m, "Category:R").collect()} == {("category:r", 0), ("category:heavy tanks", 1), ("category:german tanks", 2)}
    e = taxonomy.evidence(m, "Category:R").collect()[0]
    assert (e.title, e.classes, e.nations) == ("tank:t", ["Heavy Tanks"], ["Germany"])
    assert taxonomy.pages(m).collect()[0].page_id == 7


def test_wiki(spark):
    bodies = [
        '{"query":{"pages":[{"pageid":1,"title":"Tank:A","revisions":[{"slots":{"main":{"content":"{{Infobox vehicle|tier=7|class=TD|nation=usa}}"}}}]}]}}',
        '{"query":{"pages":{"5":{"pageid":5,"title":"Tank:B","revisions":[{"*":"{{Tankdata|nation=german|country=Germany}}"}]}}}}',
        '{"error":{"code":"x","info":"y"}}', "<html>", None, '{"query":{"pages":[{"title":"Z","missing":""}]}}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "fetch_id bigint, body string")
    revs = wiki.revisions(df)
    assert {(r.fetch_id, r.title, r.code) for r in revs.collect()} == {(0, "Tank:A", None), (1, "Tank:B", None), (2, None, "api_error"), (5, "Z", "missing_page")}
    v = {r.fetch_id: r for r in wiki.vehicles(revs).collect()}
    assert (v[0]["class"], v[0].tier, v[0].name) == ("Tank Destroyers", 7, "A") and v[1].code == "conflicting_infobox_parameters"


def test_prose(spark):
    df = spark.createDataFrame([(1, "Intro line.\n\n- Use the ridge.\n- Log in now!\r\n2) Hull down position works well.", "wiki"), (2, None, None), (3, "", "x")], "id int, text string, kind string")
    got = prose.statements(df, "text", "id").withColumn("t", prose.is_tactical(F.col("statement"))).orderBy("id", "block_no").collect()
    assert [(r.statement, r.t) for r in got] == [("Intro line.", False), ("Use the ridge.", True), ("Log in now!", False), ("Hull down position works well.", True)]
    whole = spark.createDataFrame([(1, 'It aims at 4.5 km now. Dr. Mirev holds the v2.4.7 hull. "Go now." Then he left! J. K. Oram saw it.')], "id int, text string")
    assert [r.statement for r in prose.statements(whole, "text", "id").orderBy("sentence_no").collect()] == ["It aims at 4.5 km now.", "Dr. Mirev holds the v2.4.7 hull.", '"Go now."', "Then he left!", "J. K. Oram saw it."]
    c = spark.createDataFrame([("Sniping and side-scraping at long  view range",), ("the Tanks!",), ("x",)], "c string")
    assert [r[0] for r in c.select(prose.alias_concepts(F.col("c"))).collect()] == [["sidescraping", "sniping", "view range"], [], []]
    assert [r[0] for r in c.select(prose.normalize_concept(F.col("c"))).collect()][1:] == ["tanks", "x"]
    kept = prose.by_precedence(df.withColumn("rank", prose.rank(F.col("kind"))).withColumn("k", F.lit(1)), "k", "rank", ["id"]).collect()
    assert [r.id for r in kept] == [1]
    told = spark.createDataFrame([("Aim at the shells.", ["Long-range snipes", "the Tanks", "12"])], "statement string, a array<string>")
    assert prose.extract_concepts(told, annotations="a").head().concepts == ["aim", "long-range snipe", "shell"]
    assert prose.extract_concepts(told, extractor=lambda c, a: F.array(F.lit("x"))).head().concepts == ["x"]
    e = spark.createDataFrame([(["DATE", "ORG", None], ["May", "Works", "hull"])], "l array<string>, t array<string>")
    assert e.select(prose.wanted_entities(F.col("l"), F.col("t"))).head()[0] == ["Works", "hull"]
    assert {r.identity for r in prose.segment_text(df.where("id = 1"), classes=("SPGs",)).collect()} == {"use the ridge.", "hull down position works well."}


def test_order_breaks_cross_ranges(spark):
    values = [5, 1, 2, 3, 4, 4, 6, 0]
    df = spark.createDataFrame([(i, f"{v}") for i, v in enumerate(values)], "o bigint, v string")
    want = {(i, str(v), str(values[i - 1])) for i, v in enumerate(values) if i and values[i - 1] >= v}
    for parts in (1, 3, 8):
        assert {tuple(r) for r in records.order_breaks(df, "v", "o", parts).collect()} == want


def test_streamed_edges(spark, fleet, tmp_path):
    from ferrograph.operators.graph import graph_edges
    from ferrograph.streaming.edges import streamed_edges

    src = fleet.withColumn("loaded_at", F.current_timestamp())
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = streamed_edges(stream).writeStream.format("memory").queryName("edges_out").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("edges_out").drop("loaded_at").exceptAll(graph_edges(fleet)).count() == 0 and spark.table("edges_out").count() == graph_edges(fleet).count()


def test_assemble(spark):
    from ferrograph.operators.assemble import assemble

    v = spark.createDataFrame([("A", "A", "Heavy Tanks", [], "USSR", 8), ("B", "B", "SPGs", [], "USA", 5)], "name string, display_name string, class string, subclasses array<string>, nation string, tier int")
    s = spark.createDataFrame([(None, ["Heavy Tanks"], "class_guide", "Hold the ridge with hull down armor. Angle the hull.", 1), ("A", None, "wiki", "ANGLE the hull.", 0)], "name string, applicable_classes array<string>, source_kind string, text string, ord int")
    got = {r.name: (r.strategies, r.keywords) for r in assemble(v, s).collect()}
    assert got["A"][0] == ["ANGLE the hull.", "Hold the ridge with hull down armor."] and "hull-down" in got["A"][1] and got["B"] == ([], [])
