import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrograph.functions import text, vocab, wikitext
from ferrograph.functions.addresses import clean_address, resolved_path
from ferrograph.operators import guides
from ferrograph.operators.guides import read_page


def test_golden_identity():
    value = "　Ｓｔｒａßｅ ‑ ＴＡＮＫ　"
    assert text.canonical_text(value) == "Straße - TANK" and text.identity_text(value) == "strasse - tank"
    assert text.identity_text("σ") == text.identity_text("ς")
    assert sorted(["tAnk", "Tank", "tank", "Alpha"], key=lambda v: (text.identity_text(v), v)) == ["Alpha", "Tank", "tAnk", "tank"]


@given(st.text(max_size=30))
def test_canonical_is_idempotent_on_stable_text(value):
    once = text.canonical_text(value)
    assert text.canonical_text(once) == once or text.canonical_text(text.canonical_text(once)) == text.canonical_text(once)


def test_ascii_and_general_paths_agree(spark):
    values = ["  A  b\tC ", "", "x-Y", "\n", None, "Tank:  T1"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select(text.ascii_identity(F.col("v")).alias("a"), text.identity(F.col("v")).alias("b")).collect():
        assert r.a == r.b


def test_columns_of_categories(spark):
    df = spark.createDataFrame([("Category:Tier VII tanks",), ("category:tier_10",), ("Tier 11",), ("Category:German tanks",), ("Category:Heavy_Tanks",), (None,)], "c string")
    got = df.select(text.tier_from_category(F.col("c")), text.nation_from_category(F.col("c")), text.primary_class(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(7, None, None), (10, None, None), (None, None, None), (None, "Germany", None), (None, None, "Heavy Tanks"), (None, None, None)]


def test_statement_and_url(spark):
    df = spark.createDataFrame([("• Hold  the ridge.[12] (source)", "https://u:p@h.example:8080/a/b?q=1#x")], "s string, u string")
    r = df.select(text.normalize_statement(F.col("s")).alias("s"), text.safe_url(F.col("u")).alias("u")).collect()[0]
    assert r.s == "Hold the ridge." and r.u == "h.example:8080/a/b"


def test_url_identity(spark):
    want = {
        "HTTPS://H.Example:443/a/../b/?utm_x=1&b=2&a=1&ref=z#f": "https://h.example/b/?a=1&b=2",
        "http://h.example/%252e%252e/x": "http://h.example/x",
        "ftp://h.example/": None, "https://u@h.example/": None, "https://h.example:99999/": None, "h.example/x": None, "": None, None: None, "https:///x": None, "https://h/a%00b": None,
        "http://h:8080": "http://h:8080/", "http://h/a\\b//c/.": "http://h/a/b/c", "https://h/x?b&a=%7E*+1&A=0": "https://h/x?A=0&a=~%2A+1&b=", "https://h/x?a=%zz&&": "https://h/x?a=%25zz", "https://h/ü b": "https://h/%C3%BC%20b",
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.c for r in df.select("u", clean_address(F.col("u")).alias("c")).collect()} == want
    assert resolved_path("") == "/" and resolved_path("/../..") == "/" and resolved_path("a/./b/") == "/a/b/"


def test_wikitext():
    page = "{{Infobox vehicle|tier=7|name=[[T1|Tiger]]<!-- x -->}}\n'''Bold''' [[File:x.png|thumb]] see [[A|b]].<ref>r</ref>\n{|\n|t\n|}\n== Performance ==\nGood gun.[1]\n* one\n* two\n=== Sub ===\nmore\n== Other ==\nx [[Category:Y]]"
    assert wikitext.every_template(page) == [("infobox vehicle", [("tier", "7"), ("name", "[[T1|Tiger]]<!-- x -->".replace("<!-- x -->", ""))])]
    assert [n for n, _ in wikitext.every_template("{{A|b={{C|{{D}}}}}} {{E")] == ["a", "c", "d"]
    assert wikitext.categories(page) == ["Category:Y"] and wikitext.single_line("[[T1|Ｔiger]]  x") == "Tiger x"
    assert wikitext.sections(page, {"performance"}) == [("Performance", 2, "Good gun.\none\ntwo\nSub more")]
    assert "Bold see b." in wikitext.visible(page)
    assert wikitext.visible("{{open [[x") == "{{open [[x"


def test_guide_page():
    page = "<html><title>t</title><main><h1>Roles</h1><nav>skip</nav><h2>Heavy Tanks</h2><p>Use the gun &amp; hull.<ul><li>Hold<li>Aim</ul><img alt='Side view'></main></html>"
    title, rejection, elements = read_page(page)
    assert (title, rejection) == ("Roles", None)
    assert [(t, x) for _, t, x, _ in elements] == [("h1", "Roles"), ("h2", "Heavy Tanks"), ("p", "Use the gun & hull."), ("li", "Hold"), ("li", "Aim"), ("img", "Side view")]
    assert elements[2][3] == ["Roles", "Heavy Tanks"]
    assert read_page("<main><h1>Access denied</h1></main>")[1] == "access_document"
    assert read_page("<title>x</title><p>y")[1] == "missing_root" and read_page("")[1] == "missing_title"


def test_guide_segments_and_gates(spark):
    page = "<main><h1>Tactics</h1><p>Use cover and keep the hull armor behind it at all times, whatever your vehicle is.</p><h2>Heavy Tanks</h2><p>Angle the hull armor and aim at weak spots with your view range in mind.</p><h2>Shop</h2><p>Buy.</p></main>"
    rows = [(1, page), (2, "<main><h1>Access denied</h1></main>"), (3, "<main><h1>Tactics</h1><p>Aim.</p></main>"), (4, "<main><h1>News</h1><p>Nothing here.</p></main>"), (5, None)]
    e = guides.guide_elements(spark.createDataFrame(rows, "fetch_id bigint, body string"))
    got = {(r.pos, tuple(r.applicable_classes), r.source_kind, tuple(r.tactical_concepts)) for r in guides.guide_segments(e).where("fetch_id = 1").collect()}
    every = tuple(vocab.PRIMARY_CLASSES)
    assert got == {(1, every, "universal_guide", ()), (3, ("Heavy Tanks",), "class_guide", ("view range",))}
    assert {r.fetch_id: r.code for r in guides.page_gates(e).collect()} == {2: "access_document", 3: "too_short", 4: "no_qualifying_text"}
    assert guides.guide_segments(e.limit(0)).count() == 0


def test_least_spellings(spark):
    df = spark.createDataFrame([(["b", "A", "a", None, "Ｂ", " "],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(text.sorted_unique_strings(F.col("v"))).collect()] == [[" ", "A", "b"], [], None]
    assert df.limit(1).select(F.explode("v").alias("x")).where("x is not null").select(text.case_fold(F.lit("STRAßE"))).head()[0] == "strasse"
