import json
import random

import pytest
from pyspark.sql import functions as F

from ferrograph.functions.markup import parse
from ferrograph.llm import lines
from ferrograph.llm.boilerplate import guide_lines, line_forms, main_blocks, main_content, placed
from ferrograph.llm.residue import residue_records, shape, slots, texts

WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "nrlsk"]
MENU = ["Quarn", "Brim", "Ovrin", "Helm", "Mirv", "Stead", "Tolb", "Wend"]
DEFAULTS = ["Zarp glim: the vat is on holiday.", "Grib the text comes later", "Wot no scripts, turn them on"]


def sentence(r: random.Random) -> str:
    return " ".join(r.choice(WORDS) for _ in range(r.randint(8, 14))).capitalize() + "."


def page(r: random.Random, site: int) -> tuple[str, list[int]]:
    """A page of a site and the numbers of its article's blocks."""
    menu = [f"<li><a href='/{w}'>{w}</a></li>" if r.random() < 0.7 else f"<li>{w}</li>" for w in r.sample(MENU, 5)]
    article = ["<h1>" + sentence(r)[:30] + "</h1>"] + [f"<p>{' '.join(sentence(r) for _ in range(r.randint(2, 4)))}</p>" for _ in range(r.randint(2, 5))] + ["<li>Aim low</li>"]
    inside = [f"<p>Glosed by {r.choice(WORDS)} on {r.randint(1, 28)} May</p>"] if r.random() < 0.4 else []
    below = [f"<div><a href='/x'>Perl also: {sentence(r)}</a></div>", f"<p>Glosed by {r.choice(WORDS)} on {r.randint(1, 28)} May</p>", f"<div>{r.choice(WORDS)} is an owl project</div>"]
    html = f"<html><head><title>x</title></head><body><ul>{''.join(menu)}</ul><div><div>{''.join(article)}{''.join(inside)}</div></div><div>{''.join(below)}</div></body></html>"
    return html, list(range(5, 5 + len(article)))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    rows, truth, cases = [], [], []
    for i in range(240):
        body, main = page(r, i % 6)
        rows.append((i, f"https://s{i % 6}.example/guide/{i}", body))
        truth += [("fetch", i, n) for n in main]
    for i in range(240, 300):
        menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in r.sample(MENU, 5))
        rows.append((i, f"https://s{i % 6}.example/a/{i}", f"<body><ul>{menu}</ul><div><p>{DEFAULTS[i % 3]}</p></div></body>" if i % 2 else DEFAULTS[i % 3]))
        cases.append(i)
    rows += [(300, "https://s1.example/x", "<h1>{title}</h1><p>by ${user.nick}</p>"), (301, None, None), (302, "https://s1.example/y", ""), (303, None, " \n"), (304, None, '{"query":{"pages":[{"revisions":[{"content":"{{Infobox}} It climbs well in snow."}]}]}}')]
    rows += [(305, "https://s1.example/z", '{"error":{"info":"' + DEFAULTS[0] + '"}}')]
    cases += [300, 305]
    return spark.createDataFrame([(*x, "clash") for x in rows], "fetch_id bigint, url string, body string, host string").drop("host"), truth, cases


def test_blocks_follow_the_definition():
    _, blocks = parse("a<p>b <b>c</b><br>d<img>e</p>&nbsp;<noscript>f</noscript><script>no</script><!-- no --><P>g")
    assert [b.text.split() for b in blocks] == [["a"], ["b", "c", "de"], ["f"], ["g"]]


def test_density_places_blocks():
    body = f"<body><ul><li><a href='/b'>Home</a></li><li><a href='/c'>Shop</a></li></ul><div><h1>Title</h1><p>{'The gun holds two shells in the rack. ' * 8}</p></div><p><a href='/d'>Imprint</a></p></body>"
    assert [(b.text.split()[0], inside) for b, inside in placed(body)] == [("Home", False), ("Shop", False), ("Title", True), ("The", True), ("Imprint", False)]
    nothing = lines.Lines(lambda ids: [None] * len(ids))
    assert [b.no for b in main_blocks(body, nothing)] == [2, 3]
    assert main_blocks("", nothing) == [] and main_blocks("<p></p>", nothing) == []
    assert len(main_blocks("<p>" + "x y " * 200_000, nothing)) == 1


def test_the_most_specific_known_form_decides():
    shares = {lines.form_id("phome"): 0.9, lines.form_id("phome >"): 0.8, lines.form_id("whome fire"): 0.01, lines.form_id("sread more"): 0.7}
    judge = lines.Lines(lambda ids: [shares.get(i) for i in ids])
    assert judge.outside("Home > Guides > X") == 0.8 and judge.outside("Home stretch") == 0.9
    assert judge.outside("Home fire") == 0.01  # known as a whole
    assert judge.outside("The gun is loaded … read more") == 0.7 and judge.outside("The gun") == 0.0
    assert judge.furniture("") and judge.furniture("Home > x") and not judge.furniture("The gun")
    assert guide_lines("Home > Shop\r\n\r\nHold fire\n \nHome > y\nEnd.", judge) == [(1, "Hold fire"), (3, "End.")]
    assert judge.outside("·") == 0.0 and judge.outside("x" * 100_000) == 0.0


def test_articles_are_found(spark, corpus):
    fetched, truth, _ = corpus
    guides = spark.createDataFrame([(1, "Glosed by bak on 3 May\nAim low\n" + sentence(random.Random(9)) + "\nPerl also: fen"), (2, None), (3, ""), (3, " ")], "guide_id bigint, text string")
    got = sorted((r.src, r.record_id, r.block_no) for r in main_content(guides, fetched).collect())
    assert [x for x in got if x[0] == "guide"] == [("guide", 1, 1), ("guide", 1, 2)]
    pages = {x for x in got if x[0] == "fetch"}
    assert len(pages & set(truth)) >= 0.95 * len(truth) and len(pages & set(truth)) >= 0.98 * len(pages)
    assert main_content(guides.limit(0), fetched.limit(0)).count() == 0
    copies = fetched.where("fetch_id < 240").withColumn("fetch_id", F.col("fetch_id") + 1000)
    both = {(r.record_id, r.block_no) for r in main_content(guides, fetched.unionAll(copies)).where("src = 'fetch'").collect()}
    assert {(k % 1000, n) for k, n in both if k >= 1000} == {x[1:] for x in pages} == {x for x in both if x[0] < 1000}


def test_many_forms_are_joined_instead(spark, corpus):
    fetched, _, _ = corpus
    few = line_forms(fetched)
    many = lines.Learned(few.shares, few=0)
    row = many.beside(fetched, "fetch_id", "body", texts).where("fetch_id = 7").head()
    a, b = few.judge()(None, None), many.judge()(row.known_forms, row.known_shares)
    assert many.broadcast is None and len(row.known_forms) > 10
    assert [x.no for x in main_blocks(row.body, a)] == [x.no for x in main_blocks(row.body, b)]


def test_residue_is_learned(spark, corpus):
    fetched, _, cases = corpus
    assert sorted(r.fetch_id for r in residue_records(fetched).collect()) == cases
    assert residue_records(fetched.limit(0)).count() == 0
    again = residue_records(fetched.unionAll(fetched.where("fetch_id = 300")))
    assert sorted(r.fetch_id for r in again.collect()) == sorted([*cases, 300])


def test_shapes():
    assert shape("by {{name}} Tier: %tier%") == "" and shape("[object Object] null") == ""
    assert shape("foo bar foo bar") == shape("foo bar") and shape("Error 12 at 3") == shape("Error 7 at 99")
    assert shape("Exception in a.b(): x") == shape("Exception in cd.e(): x") and shape("Zarp glim. " * 500) == "Zarp glim."
    nothing = lines.Lines(lambda ids: [None] * len(ids))
    assert slots(json.dumps({"query": {"pages": [{"title": "T", "revisions": [{"content": "Real text.\n{{x}}"}]}]}}), nothing) == ["Real text.", ""]


def test_records_that_only_repeat_themselves_are_no_cases(spark):
    rows = [(i, f"https://one.example/a/{i}", "<p>The gun holds two shells.</p>") for i in range(6)] + [(9, None, "<p>The gun.</p>")]
    assert residue_records(spark.createDataFrame(rows, "fetch_id bigint, url string, body string")).count() == 0


def test_long_whole_pages_are_learned(spark):
    notice = "".join("<p>" + " ".join(f"{a}{b}{c}{d}ar" for c in "lnrst" for d in "aeiou" for b in "ou") + "</p>" for a in "bdfgk")
    rows = [(i, f"https://s{i % 3}.example/a{i}", notice) for i in range(9)] + [(50 + i, f"https://m{i}.example/one", notice.replace("ar", "em")) for i in range(9)]
    got = residue_records(spark.createDataFrame(rows, "fetch_id bigint, url string, body string"))
    assert sorted(r.fetch_id for r in got.collect()) == list(range(9))


def test_blocks_of_a_site_are_no_slots(spark):
    menu = "<div>Quarnel of the Brimstead</div><p>Ovrin helmaker seeks a mirvane</p>"
    rows = [(i, f"https://one.example/guide/{i}", f"{menu}<p>{' '.join(WORDS[i * 7 : i * 7 + 60])}</p>") for i in range(30)]
    rows += [(101, "https://one.example/y", f"{menu}<p>{{{{name}}}}</p>"), (301, None, menu)]
    df = spark.createDataFrame(rows, "fetch_id bigint, url string, body string")
    assert sorted(r.fetch_id for r in residue_records(df).collect()) == [101]
