import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrograph.llm import encoding, leaks
from ferrograph.llm.subjects import Settings, Vocabulary, assign, composition, parts_of, proportions, rounds_of, terms, unlabelled
from ferrograph.llm.transducer import Transducer, build

RANKS = Path(encoding.TOKENIZERS) / "byte_bpe_50k.tiktoken"
needs_files = pytest.mark.skipif(not RANKS.exists(), reason="no vocabulary files")


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 60_000), max_size=3), max_size=60))
def test_transducer_round_trip(tmp_path_factory, words):
    path = tmp_path_factory.mktemp("t") / "x.bin"
    build(sorted(words.items()), path)
    t = Transducer(str(path))
    assert all(t.get(w) == ids for w, ids in words.items())
    assert all(t.get(w + b"z") is None for w in words if w + b"z" not in words) and (b"" in words or t.get(b"") is None)


def test_suffixes_are_shared(tmp_path):
    words = sorted(f"{a}{b}ing".encode() for a in "abcdefgh" for b in "xyz")
    assert build([(w, [1]) for w in words], tmp_path / "x.bin") == 6


@needs_files
def test_merge_is_exact():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = encoding.read_ranks(str(RANKS))
    enc = tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for text in ["hello", " worlds", "สวัสดีครับ" * 30, "aaaaaaaaaaaaaaaa", "\U0001f6e1️", "".join(rng.choice("etaoin ") for _ in range(300)).replace(" ", "")]:
        assert encoding.merge(text.encode(), ranks) == enc._encode_single_piece(text.encode())


@needs_files
def test_encode_rows(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tk = tokenizers.Tokenizer.from_file(str(Path(encoding.TOKENIZERS) / "byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    texts = ["The gun, the gun!", "", None, "   \n\t ", "<|endoftext|> it's 12 ｶﾞ 守住山口。", "x" * 50_000, "The gun, the gun!"]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in encoding.encode(df, str(RANKS)).collect()}
    assert got == {i: tk.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    assert encoding.encode(df.limit(0), str(RANKS)).count() == 0
    assert encoding.encode(df, str(RANKS)).schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"


ITEM = "Clerk Bebren swore that porter Weivold had signed for 237 of them when frost reached Grobrapur at noon."
ZH = "车长风白林在川岩塔仓库清点了905箱备件然后离开了山口"


def corpus():
    w = ITEM.split()
    return [
        (1, "Intro. " + " ".join(w[2:14]).upper().replace(" ", ",\n") + " outro"), (2, " ".join(w[2:13])), (3, " ".join(w[:5] + ["odd"] + w[6:15])), (4, "前言" + "，".join(ZH[:20]) + "。"),
        (5, ZH[:19]), (6, None), (7, ""), (8, "C​lеrk " + " ".join(w[1:12])), (9, " ".join(w[:6])), (10, " ".join(w[6:12])), (11, " ".join(w * 400)),
    ]


def test_leaks(spark):
    docs = spark.createDataFrame([(*r, "x") for r in corpus()], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(1, "s", ITEM), (2, "s", ZH), (3, "s", None), (4, "s", "too short"), (5, "s", ITEM)], "item_id bigint, suite string, text string")
    got = {tuple(r) for r in leaks.contained(docs, items).collect()}
    assert got == {(d, i) for d in (1, 8, 11) for i in (1, 5)} | {(4, 2)}
    assert {tuple(r) for r in _contained(docs, items, block=1)} == got
    near = {r.doc_id: (r.fewest_edits, r["items"]) for r in leaks.leaked_documents(docs, items, leaks.Plan(edits=1, recall=0.999)).collect()}
    assert near[3] == (1, [1, 5]) and near[4] == (0, [2]) and near[1][0] == 0 and set(near) == {1, 3, 4, 8, 11}
    assert leaks.contained(docs.limit(0), items).count() == 0 and leaks.contained(docs, items.limit(0)).count() == 0


def brute(docs, items):
    """(doc_id, item_id, windows, edits) by comparing all windows of equal size; at most one symbol differs."""
    out = {}
    symbol = leaks.Symbols()
    for d, text in docs:
        for i, item in items:
            if not text or not item:
                continue
            size = leaks.LETTERS if leaks._HAN.search(item) else leaks.WORDS
            cut = (lambda t: [ord(c) for c in leaks.letters(t)]) if size == leaks.LETTERS else (lambda t: [symbol[w] for w in leaks.words(t)])
            a, b = cut(text), cut(item)
            others = [b[y : y + size] for y in range(len(b) - size + 1)]
            for x in range(len(a) - size + 1):
                least = min((leaks.edit_distance(a[x : x + size], o, 1) for o in others), default=9)
                if least <= 1:
                    have = out.setdefault((d, i), [0, least])
                    out[d, i] = [have[0] + 1, min(have[1], least)]
    return {(d, i, n, e) for (d, i), (n, e) in out.items()}


def test_the_shuffle_finds_what_the_broadcast_finds_and_what_there_is(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(15))) for i in range(12)] + [(20, ZH)]
    rows = []
    for k in range(40):
        text = [rng.choice(vocabulary) for _ in range(20)]
        part = items[k % 12][1].split()[:13]
        part[rng.randrange(13)] = "odd" if k % 3 else part[0]
        rows.append((k, " ".join(text + part + text)))
    rows += [(50, None), (51, ""), (52, "前" + ZH[:20]), (53, ZH[:10] + "错" + ZH[11:20])]
    docs, asked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    plan = leaks.Plan(edits=1, recall=0.99)
    a, b = ({tuple(r) for r in leaks.find_leaks(docs, asked, plan, block=n).collect()} for n in (1_000, 1))
    truth = brute(rows, items)
    assert a == b and len({x[:2] for x in a} & {x[:2] for x in truth}) >= 0.95 * len({x[:2] for x in truth}) and {x[:2] for x in a} <= {x[:2] for x in truth}
    assert {x for x in a if x[3] == 0} >= {x for x in truth if x[3] == 0 and x[0] >= 50}
    assert leaks.find_leaks(docs.limit(0), asked, plan, block=1).count() == 0


def _contained(docs, items, block):
    return leaks.find_leaks(docs, items, block=block).where("edits = 0").select("doc_id", "item_id").distinct().collect()


def test_recall_of_the_tables_against_brute_force():
    rng = random.Random(5)
    plan = leaks.Plan(edits=1, recall=0.95)
    words = [rng.getrandbits(60) | 1 for _ in range(500)]
    items = [[rng.choice(words) for _ in range(leaks.WORDS)] for _ in range(400)]
    changed = []
    for it in items:
        c = list(it)
        kind, at = rng.randrange(3), rng.randrange(leaks.WORDS)
        if kind == 0:
            c[at] = rng.choice(words)
        elif kind == 1:
            c = c[:at] + [rng.choice(words)] + c[at:-1]
        else:
            c = c[:at] + c[at + 1 :] + [rng.choice(words)]
        changed.append(c)
    a, b = (np.array([x for it in s for x in it], np.uint64) for s in (items, changed))
    starts = np.arange(0, len(a), leaks.WORDS)
    hit = np.zeros(len(items), bool)
    for t in range(plan.tables(leaks.WORDS)):
        hit |= leaks.keys(a, starts, leaks.WORDS, t, plan) == leaks.keys(b, starts, leaks.WORDS, t, plan)
    near = np.array([leaks.edit_distance(x, y, 1) <= 1 for x, y in zip(items, changed, strict=True)])
    assert near.sum() > 50 and hit[near].mean() >= 0.9
    assert leaks.edit_distance([1, 2, 3], [1, 3, 4], 2) == 2 and leaks.edit_distance([1], [2, 3, 4], 1) == 2


def subject_corpus():
    rng = random.Random(7)
    areas = {1: "gun shell barrel breech tracer".split(), 2: "engine track gearbox suspension fuel".split(), 3: "league referee season trophy bracket".split()}
    docs, labels, truth = [], [], {}
    for k in range(240):
        own = rng.sample(list(areas), rng.choice((1, 1, 2)))
        text = " ".join(f"The {rng.choice(areas[s])} needs the {rng.choice(areas[s])} today." for s in own for _ in range(5)) + " Thanks for reading."
        docs.append((k, text, "en" if k % 7 else None))
        truth[k] = set(own)
        labels += [(k, s, "a", None) for s in own if k % 3 == 0]
    return docs + [(900, None, "en"), (901, "", None), (902, " ", "en"), (903, "Thanks for reading. See you there.", "xx")], labels, truth


def test_subjects(spark):
    docs, labels, truth = subject_corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, lang string, subject_id int")
    lab = spark.createDataFrame(labels, "doc_id bigint, subject_id bigint, annotator string, labelled_at timestamp")
    s = Settings(topics=6, rounds=15, most_share=0.9)
    got: dict = {}
    for r in assign(d, lab, s).collect():
        got.setdefault(r.doc_id, set()).add(r.subject_id)
    right = sum(got.get(k, set()) == v for k, v in truth.items() if k % 3)
    assert right >= 0.9 * sum(k % 3 > 0 for k in truth) and not {900, 901, 902, 903} & set(got)
    assert all(r.doc_id % 3 or r.doc_id >= 900 for r in unlabelled(d, lab, s).collect())
    assert {r.subject_id for r in composition(d, lab, s).collect()} == {1, 2, 3}
    assert assign(d, lab.limit(0), s).count() == 0 and assign(d.limit(0), lab, s).count() == 0


def test_terms():
    assert terms("Ｔhe GUN-7 守住山口") == ["the", "gun", "守住", "住山", "山口"] and terms("") == []


@pytest.mark.parametrize("n_docs", [0, 1, 4_000, 10_000, 100_000, 1_000_000, 10**10])
def test_every_part_is_read_equally_often(n_docs):
    n = parts_of(n_docs, Settings())
    rounds = rounds_of(n, Settings())
    assert rounds % n == 0 and n <= rounds <= 45


def test_proportions_follow_the_words():
    phi = np.array([[0.8, 0.05], [0.15, 0.05], [0.05, 0.9]], np.float32)
    each, theta = proportions(np.array([0, 1, 2, 0, 2]), np.array([3, 1, 4, 1, 1], np.float32), np.array([0, 2, 3]), phi, Settings())
    assert theta.shape == (3, 2) and theta[0, 0] > 0.9 and theta[1, 1] > 0.95 and 0.2 < theta[2, 0] < 0.8
    assert np.allclose(each.sum(1), [3, 1, 4, 1, 1], atol=1e-4)


def test_terms_tell_the_language():
    import pandas as pd

    rows = [(x, "", 30) for x in ("aa", "bb")] + [(x, f"{x}w{i}", 20) for x in ("aa", "bb") for i in range(40)] + [("cc", "", 3), ("cc", "rare", 3)]
    v = Vocabulary(pd.DataFrame(rows, columns=["lang", "term", "n"]), Settings())
    assert v.langs == ["aa", "bb"] and v.topics == [13, 13]
    assert v.language({"bbw1": 1, "bbw2": 1, "aaw1": 1}, "aa") == 1 and v.language({"x": 1}, "bb") == 1 and v.language({"x": 1}, "") is None
