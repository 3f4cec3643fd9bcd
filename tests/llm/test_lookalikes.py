import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ferrograph.llm.glyphs import glyphs, spell_text
from ferrograph.llm.lookalikes import Trie, match_labels, near_labels, same_reading, unify

TANKS = "row_id bigint, display_name string, strategies array<string>, keywords array<string>, label string, field int"
LABELS = "label_id bigint, field string, label string"


@pytest.mark.parametrize("other", ["Ｄräleben  Bau. G", "Dräleben Bau. G", "​Drä­leben Bau. G ", "Dräӏеbеn Βаu. Ԍ", "𝐃𝐫ä𝐥𝐞𝐛𝐞𝐧 𝐁𝐚𝐮. 𝐆", "Dräleben　Bau．\tG"])
def test_same_reading(other):
    assert glyphs(other) == glyphs("Dräleben Bau. G") and other != "Dräleben Bau. G"


@pytest.mark.parametrize("other", ["dräleben Bau. G", "Draleben Bau. G", "DrälebenBau. G", "Dräleben Bau. 6", "Dräleben Bau G", "Dräleben-Bau. G"])
def test_other_reading(other):
    assert glyphs(other) != glyphs("Dräleben Bau. G")


@pytest.mark.parametrize(("a", "b"), [("ﬁeld Ⅳ", "field IV"), ("T‑7−2", "T-7-2"), ("デリギ", "ﾃﾞﾘｷﾞ"), ("한길각", "한길각"), ("ＦΚ", "FK"), ("⽔", "水"), ("Объект", "Oбъeкт"), ("ꓐⲞX", "BOX")])
def test_pairs(a, b):
    assert glyphs(a) == glyphs(b)


@given(st.text(max_size=40))
def test_reading_is_stable(value):
    seen = glyphs(value)
    assert glyphs(seen) == seen or glyphs(glyphs(seen)) == glyphs(seen)
    assert glyphs("​" + value) == seen or value == ""


def test_one_spelling_by_script():
    assert spell_text(glyphs("Oбъeкт ѕрace")) == "Объект space"


def test_trie_against_brute_force():
    rng = random.Random(1)
    words = sorted({glyphs("a" + "".join(rng.choice("abAB -") for _ in range(rng.randint(0, 5)))) for _ in range(160)})
    trie = Trie((w, w) for w in words)

    def distance(a, b):
        gap = lambda c: 0.5 if c in " -" else 1.0
        row = [0.0]
        for y in b:
            row.append(row[-1] + gap(y))
        for x in a:
            new = [row[0] + gap(x)]
            for j, y in enumerate(b):
                swap = 0 if x == y else 0.5 if x.lower() == y.lower() or {x, y} == {" ", "-"} else 1
                new.append(min(row[j] + swap, row[j + 1] + gap(x), new[j] + gap(y)))
            row = new
        return row[-1]

    for _ in range(120):
        q = "a" + "".join(rng.choice("abAB -") for _ in range(rng.randint(0, 5))).rstrip().replace("  ", " ")
        for budget in (0, 0.5, 1, 2):
            assert {(c, v) for c, v in trie.find(q, budget)} == {(d, w) for w in words if (d := distance(glyphs(q), w)) <= budget}


@given(st.text(max_size=12))
def test_the_walk_reads_what_is_seen(value):
    trie = Trie([(value, 1), ("zzz", 2)])
    if glyphs(value):
        assert trie.find(value) == [(0.0, 1)] or glyphs(value) == "zzz"
    assert trie.find("​ " + value + " ") == trie.find(value)
    assert trie.find("") == []


def test_weights_and_near_values(spark):
    trie = Trie([("weak spot", 1)])
    assert [trie.find(x, 1)[0][0] for x in ("weаk  spot", "weak-spot", "weakspot", "Weak spot", "weak spöt", "weak spots")] == [0.0, 0.5, 0.5, 0.5, 0.5, 1.0]
    assert trie.find("weak sp", 1) == [] and trie.find("x" * 50_000, 1) == []
    labels = spark.createDataFrame([(1, "keywords", "weak spot"), (2, "keywords", "weak spots")], LABELS)
    t = spark.createDataFrame([(1, None, None, ["weak sp0t", "wеak spot", None, "far off"], None, None)] * 2, TANKS)
    for block in (10, 1):
        assert {tuple(r) for r in near_labels(t, labels, ["display_name"], ["keywords"], block=block).collect()} == {("keywords", "weak sp0t", 1, 1.0)}
        u = {(r.field, r.item_no): (r.unified, r.label_id) for r in unify(t, labels, "row_id", ["display_name"], ["keywords"], block=block).collect()}
        assert u == {("keywords", 0): ("weak sp0t", None), ("keywords", 1): ("weak spot", 1), ("keywords", 3): ("far off", None)}
    assert near_labels(t, labels.limit(0), ["display_name"], ["keywords"]).count() == 0


def test_rows(spark):
    labels = spark.createDataFrame([(1, "display_name", "Kedobren IX"), (2, "keywords", "weak spot"), (3, "keywords", "weak  spot"), (4, "keywords", None), (5, "strategies", " ")], LABELS)
    rows = [
        (1, "Kedobren Ⅸ", [None, "", " "], ["weak​ spot", "wеak spot", None, "weak spot"], "x", 9),
        (2, None, None, None, None, None),
        (3, "Kedobren IX", [], ["x" * 100_000 + "ﬁ"], None, None),
        (3, "Kedobren IX", [], [], None, None),
    ]
    t = spark.createDataFrame(rows, TANKS)
    assert {tuple(r) for r in same_reading(t, labels).collect()} == {("display_name", 1, 1), ("keywords", 1, 2), ("keywords", 1, 3)}
    assert {tuple(r) for r in same_reading(t, labels.limit(0)).collect()} == set() and same_reading(t.limit(0), labels).count() == 0
    small = match_labels(t, labels, "row_id", ["display_name"], ["keywords"], block=1)
    assert small.count() == match_labels(t, labels, "row_id", ["display_name"], ["keywords"]).count()
    u = {(r.row_id, r.field, r.item_no): (r.unified, r.label_id) for r in unify(t, labels, "row_id", ["display_name"], ["strategies", "keywords"]).collect()}
    assert u[1, "display_name", 0] == ("Kedobren IX", 1) and u[1, "keywords", 1] == ("weak spot", 2) and u[1, "strategies", 1] == ("", None)
    assert u[3, "keywords", 0][0] == "x" * 100_000 + "fi"
