import pytest

from ferrograph.llm.sentences import _Document, period_counts, sentence_starts, sentences, split_sentences, statements, token_kinds

CASES = [
    ("See fig. 8 and p. 510. The K.D.F. hull holds, i.e. most of it.", 2),
    ("J. K. Mirev drove to St. Orven. Gen. Oram vs. Col. Dask at 2 p.m. Hold!", 3),
    ('"Stay off. It is a trap!" was the order. The manual warns: "Never peek." At 4.5 km it hits.', 3),
    ("A gain of 44.9 %.[2] Next one.[3]", 2),
    ("Use it (not the road!) now. (A remark. Two.) It holds...but waits. Wait... then go", 4),
    ("1) One. Two\n2) Three\n- no item", 3),
    ("Heading\n\nText goes\non here.\r\n \r\nMore", 3),
    ("Das misst ca. 480 mm, z. B. hier. Am 9. Mai steht er seit dem 9. 4. bereit. »Wer?«, fragt er.", 3),
    ("Орудие и т. д., затем стой. См. табл. 8. В 83 г. до н. э. пусто. «Стой! Нет!» — кричит он.", 4),
    ("守住山口。“守住。不要过桥！”车长说。他等……然后才开火。《手册。第3版》有。", 4),
    ("「撃て！止まるな！」と叫んだ。約4.5ミリである。なぜ？", 3),
    ("क्या कोई है? “रुको। गोली!” FK का कमांडर बोला। डॉ. ओराम आए।", 3),
    ("قال د. فلدت إن المدى 690 متر. من يراقب؟ «قف! لا!» صاح.", 3),
    ("ጠብቅ። ማን ይመለከታል፧ ተኩስ።", 3),
    ("รถ T-57 หมุนช้า อย่าข้ามสะพาน หนา 71.4 มิลลิเมตร", 3),
    ("Ποιος φυλάει; «Σταμάτα! Μην!» φώναξε. Τα 99 μ. στο πεδίο.", 3),
    ("Trekt an.Nutzen Sie es. Patch v2.4.7 on drellfolio.example is out.", 3),
    ("¡Cuidado! ¿Quién cubre? El Sr. Oram.", 3),
    ("Ｄｒ．  Ｏｒａｍ ｓａｗ ｉｔ． Ｓｔｏｐ！", 2),
    ("", 0), (" \n\t", 0), ("x", 1),
]


@pytest.mark.parametrize(("text", "n"), CASES)
def test_counts(text, n):
    assert len(split_sentences(text)) == n, split_sentences(text)


def test_offsets_are_of_the_stored_text():
    text = "  - 𝐇𝐨𝐥𝐝​ it.  «Go! Now!» he said.\n  - Next"
    assert [text[i] for i in sentence_starts(text)] == ["𝐇", "«", "N"]
    assert sentence_starts("a. ​B")[1] == 3


def test_the_document_decides():
    alone = "He met Zorb. Kalt there."
    assert len(split_sentences(alone)) == 2
    told = _Document([alone, "The Zorb. unit saw Kalt again. With Kalt it held."], {})
    assert len(split_sentences(alone, told)) == 1
    learned = _Document([alone, "They saw Kalt."], {"zorb": "never"})
    assert len(split_sentences(alone, learned)) == 1


def test_long_text_in_one_pass():
    assert len(split_sentences("Hold the line. " * 20_000)) == 20_000


def test_corpus_and_rows(spark):
    texts = [("The qx. Unit met the Lork. F at the gun.",)] * 8 + [("A no. The unit. So we hold etk. and go etk.",)] * 8 + [(None,), ("",)]
    kinds = token_kinds(period_counts(spark.createDataFrame(texts, "text string")), expected=2.0)
    assert {r.token: r.kind for r in kinds.collect()} == {"qx": "never", "lork": "mark", "etk": "maybe", "unit": "never", "no": "never"}
    assert token_kinds(period_counts(spark.createDataFrame([], "text string"))).count() == 0
    segments = spark.createDataFrame([(1, "One. Two.", "x"), (1, "One. Two.", "x"), (2, None, None), (3, " ", "")], "segment_id bigint, text string, record_id string")
    tanks = spark.createDataFrame([(7, [None, "Hold it. Cd went.", ""]), (8, None), (9, [])], "row_id bigint, strategies array<string>")
    got = sorted((r.src, r.record_id, r.item_no, r.sentence_no, r.start_char) for r in statements(segments, tanks).collect())
    assert got == [("segment", 1, 0, 0, 0)] * 2 + [("segment", 1, 0, 1, 5)] * 2 + [("strategies", 7, 1, 0, 0), ("strategies", 7, 1, 1, 9)]
    assert statements(segments.limit(0), tanks.limit(0)).count() == 0


def test_the_document_overrules_the_table():
    assert len(split_sentences("The answer was no. The crew left. There was no other way.")) == 3
    assert len(split_sentences("See vol. Three of it.")) == 1
    assert len(split_sentences("A Regimentz. Kalt came. The Regimentz. unit saw Kalt. With Kalt it held.")) == 3


def test_the_corpus_overrules_the_table_and_the_document_the_corpus():
    text = "He met Zorb. Kalt there. Bring etc. Kalt came."
    assert len(split_sentences(text)) == 4
    assert len(split_sentences(text, _Document([text], {"zorb": "never", "etc": "never"}))) == 2
    assert len(split_sentences("He met Dr. Kalt.", _Document([], {"dr": "word"}))) == 2
    said = text + " The zorb is big, zorb of old."
    assert len(split_sentences(said, _Document([said], {"zorb": "never"}))) == 5
    assert len(split_sentences("The Lork. F left. The Qx. F. Kalt left.", _Document([], {"lork": "mark", "qx": "never"}))) == 2


def test_many_learned_tokens_are_joined_instead(spark):
    docs = spark.createDataFrame([("a", 1, ["He met Zorb. Kalt there.", None]), ("a", 2, ["Go on."]), ("b", 1, None)], "src string, record_id bigint, texts array<string>")
    learned = spark.createDataFrame([("zorb", "never"), ("x", "never")], "token string, kind string")
    a, b = (sorted((r.src, r.record_id, r.start_char) for r in sentences(docs, learned, few=n).collect()) for n in (10, 0))
    assert a == b == [("a", 1, 0), ("a", 2, 0)]
