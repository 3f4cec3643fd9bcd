"""Sentence boundaries across languages and scripts.

Document-centred disambiguation: whether a period belongs to an abbreviation, and whether a capital belongs to
a proper name, is read from the places of the same document where neither is in doubt; where the document
is silent, the whole corpus decides, by how often a token with a period ends a text; a table of common abbreviations is asked
last, for tokens the corpus has too few of. Scripts without letter case have terminators of their own; Thai has blanks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import spread
from .glyphs import glyphs, zero_cost

# Abbreviations that don't end a sentence, whatever follows. Asked where document and corpus are silent.
NEVER_FINAL = """
dr mr mrs ms prof gen col lt sgt capt maj cpl cmdr adm rev hon st mt no nos nr fig figs vol vols ch chap p pp ed eds
approx ca cf vs v max dept est e.g i.e a.k.a viz jan feb mar apr jun jul aug sep sept oct nov dec
abb vgl bzw z b d h s str inkl exkl evtl ggf sog geb hr fr dipl ing tab kap bd
mme mlle art env av éd n sr sra srta dra pág págs aprox núm ud uds cap ej
рис табл гл с ср им см т тыс млн ул стр проф акад ген полк св е
περ σελ εικ π.χ δηλ αρ κ डॉ श्री प्रो सं ዶ
"""
# Abbreviations and units that can also end a sentence; a capital after them starts a new one.
MAYBE_FINAL = """
etc inc ltd co corp jr p.m a.m m km cm mm kg hp sec min deg usw u.a a al м км г э д п чел руб μ χιλ κ.λπ
"""
# Months after an ordinal.
MONTHS = "januar jänner februar märz april mai juni juli august september oktober november dezember"
NEVER, MAYBE, MONTH = (frozenset(glyphs(x) for x in words.split()) for words in (NEVER_FINAL, MAYBE_FINAL, MONTHS))

CJK_END, OWN_END = "。！？｡", "؟۔।॥።፧፨"
_END = regex.compile(rf"[.!?…;{CJK_END}{OWN_END}]+")
_LINE = regex.compile(r"\r\n?|[\n\u0085  ]")
_MARK = regex.compile(r"[^\S\n]*(?:([-–*•‣◦▪●○·])|(\d{1,3})[.)])(?=\s)\s*")
_KEEP = frozenset("！？，；：（）。、…")
_FOLD_CANDIDATE = regex.compile(r"[^\x00-\x7f\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Arabic}\p{Devanagari}\p{Ethiopic}àâäáãçéèêëíìîïñóòôöõúùûüßÀÂÄÉÈÊÖÜ«»„“”…–。！？，；：（）、「」《》¿¡]|\p{Cf}")
_PAIR = {"(": ")", "（": "）", "[": "]", "【": "】", "《": "》", "〈": "〉", "「": "」", "『": "』", "“": "”", "„": "“", "{": "}"}
_CLOSERS = frozenset(_PAIR.values()) | frozenset("»«\"’”")
_PAIRED = regex.compile(r"""[()（）\[\]【】《》〈〉「」『』“”„«»"{}]""")
_CITE = regex.compile(r"\s?\[\d+(?:\s?[,–-]\s?\d+)*\]|[¹²³⁰-⁹]+")
_OPEN = frozenset("“„«»「『《〈（([【¿¡‹")
_TOKEN = regex.compile(r"(?r)(?:[\p{L}\p{M}]\.)*[\p{L}\p{M}\p{N}]+")  # read backwards from its end
_CAMEL = regex.compile(r"\p{Ll}{1,3}\p{Lu}")
_SYMBOL = regex.compile(r"[\p{So}\p{Sk}\uFE0F\u200d]")
_GREEK = regex.compile(r"\p{Greek}{2}")
_WORD = regex.compile(r"[\p{L}\p{M}]+")
_CASED = regex.compile(r"[\p{Lu}\p{Ll}\p{Lt}]")
_THAI_BLANK = regex.compile(r"(?<=[\p{Thai}&&[\p{L}\p{M}]])[^\S\n\r]+(?=[\p{Thai}&&[\p{L}\p{M}]])", regex.V1)
_DESIGNATION = regex.compile(r"(?r)(?:\d[ \-]?|[-–]|\p{Lu}[\p{L}\p{M}]{3,}\s+)\p{L}")
_AFTER_MARK = regex.compile(r"(?r)([\p{L}\p{M}]+)\.\s*\p{L}")
_DOC_ABBR = regex.compile(r"(?<![\p{L}\p{M}.])([\p{L}\p{M}]+)\.(?=[,:;]|\s+\p{Ll}(?!\p{Lu}))")
_DOC_PLAIN = regex.compile(r"(?<![\p{L}\p{M}.])([\p{L}\p{M}]{2,})(?=[,:;]|\s+\p{Ll})")
#: What the corpus pass counts: a token with a period, and what follows it (nothing or an empty line, a mark, or a blank and up to two characters).
CORPUS_TOKEN = r"(?U)(?<![\p{L}\p{M}\p{N}.])((?:[\p{L}\p{M}]\.)*[\p{L}\p{M}]+)\.(?=(\s*\z|\s*\n\s*\n|[,:;)\]]|\s+\p{Lu}(?![\p{L}\p{M}.])|\s+\S.?))"
NEVER_KIND, MAYBE_KIND, MARK_KIND, WORD_KIND = "never", "maybe", "mark", "word"
#: Learned tokens of at most this many are sent to the tasks; more are joined by a shuffle.
FEW = 500_000


class _Styles(dict):
    """Characters that need folding to their plain letters, filled as they are met."""

    def __missing__(self, c: str) -> str:
        import unicodedata

        seen = zero_cost().get(ord(c), c)
        if seen and seen != " " and c not in _KEEP and not c.isspace():
            plain = unicodedata.normalize("NFKC", seen)
            seen = plain if len(c) == 1 and plain.strip() else seen
        self[c] = out = "" if seen is None else c if c.isspace() else seen
        return out


_styles = _Styles()


def _shadow(text: str) -> tuple[str, list[int] | None]:
    """The text in plain letters, without what can't be seen, and each letter's place in the text (None: the same)."""
    if text.isascii() or not _FOLD_CANDIDATE.search(text):
        return text, None
    out, at = [], []
    for i, c in enumerate(text):
        for x in c if c < "\x80" else _styles[c]:
            out.append(x)
            at.append(i)
    return "".join(out), at


def _blocks(s: str) -> list[tuple[int, int]]:
    """(start of content, end) of paragraphs and list items; list marks and empty lines lie between them."""
    lines, at = [], 0
    for m in _LINE.finditer(s):
        lines.append((at, m.start()))
        at = m.end()
    lines.append((at, len(s)))
    if len(lines) == 1 and not _MARK.match(s):
        return [(0, len(s))]
    marks = [_MARK.match(s, a, b + 1) if b > a else None for a, b in lines]
    numbers = [int(m[2]) if m and m[2] else None for m in marks]
    bullets = [m[1] if m else None for m in marks]
    blocks, fresh, last_no, last_bullet = [], True, None, None
    for k, (a, b) in enumerate(lines):
        if not s[a:b].strip():
            fresh = True
            continue
        m, start, item = marks[k], a, False
        if m:
            if bullets[k]:
                item = fresh or last_bullet == bullets[k] or bullets[k] not in "-–" or bullets.count(bullets[k]) > 1 or s[lines[k - 1][1] - 1 : lines[k - 1][1]] == ":"
            else:
                item = numbers[k] == (last_no or 0) + 1 or (fresh and numbers[k] in (0, 1)) or (fresh and numbers[k] + 1 in numbers[k + 1 :])
            if item:
                start = min(m.end(), b)
                last_no, last_bullet = numbers[k], bullets[k]
        if fresh or item or not blocks:
            if not item:
                last_no = last_bullet = None
            blocks.append((start, b))
        else:
            blocks[-1] = (blocks[-1][0], b)
        fresh = False
    return blocks


def _spans(s: str, a: int, b: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Outermost quotations and brackets of a block, and where any opens. Marks without a partner count for nothing."""
    pairs, stack = [], []
    for m in _PAIRED.finditer(s, a, b):
        c, i = m[0], m.start()
        if c == '"':
            close = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
        elif c in "«»":
            other = "»" if c == "«" else "«"
            close = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == other), None)
        elif c == "“":
            close = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "„"), None)
        elif c in _PAIR:
            close = None
        else:
            close = next((k for k in range(len(stack) - 1, -1, -1) if _PAIR.get(stack[k][0]) == c or (c == "”" and stack[k][0] == "„")), -1)
            if close == -1:
                continue
        if close is None:
            stack.append((c, i))
        else:
            pairs.append((stack[close][1], i))
            del stack[close:]
    pairs.sort()
    outer: list[tuple[int, int]] = []
    for p in pairs:
        if not outer or p[0] > outer[-1][1]:
            outer.append(p)
    return outer, {p[0] for p in pairs}


class _Document:
    """What the document's own unambiguous places tell."""

    def __init__(self, texts: Iterable[str], learned: dict[str, str]):
        self.texts, self.learned = list(texts), learned
        self._abbr: set | None = None
        self._names: set | None = None

    def says(self, key: str) -> bool | None:
        """Whether the word is an abbreviation by its places in the document: before a small letter or comma with a period, or without one; None if there are none or both."""
        if self._abbr is None:
            self._abbr = {glyphs(x).lower() for t in self.texts for x in _DOC_ABBR.findall(t)}
            self._plain = {glyphs(x).lower() for t in self.texts for x in _DOC_PLAIN.findall(t)}
        held, plain = key in self._abbr, key in self._plain
        return held if held != plain else None

    def kind(self, key: str) -> str | None:
        """What the corpus says of a token with a period, else the table: that it never ends a sentence (``mark``: and stands before a letter), may end one, or is a word; None if neither knows it."""
        if (found := self.learned.get(key)) is not None:
            return found
        last = key.rpartition(".")[2]
        return NEVER_KIND if key in NEVER or (last in NEVER and last != key and len(last) > 1) else MAYBE_KIND if key in MAYBE else None

    def name(self, word: str) -> bool:
        """Capital inside sentences of the document, and nowhere in small letters."""
        if self._names is None:
            inside, small = set(), set()
            for t in self.texts:
                inside.update(regex.findall(r"(?<=\p{Ll}\s)\p{Lu}[\p{L}\p{M}]+", t))
                small.update(x.capitalize() for x in regex.findall(r"(?<![\p{L}\p{M}])\p{Ll}[\p{L}\p{M}]+", t))
            self._names = inside - small
        return word in self._names


def _ends(s: str, first: int, since: int, i: int, stop: int, j: int, k: int, quoted: bool, opens: set[int], doc: _Document) -> bool:
    """Whether the terminators s[i:stop], with closing marks up to j, end a sentence before s[k]; the block starts at ``first``, the sentence at ``since``."""
    cluster, gap = s[i:stop], k > j
    while k + 1 < len(s) and (_SYMBOL.match(s, k) or s[k].isspace()):
        k += 1  # an emblem before a sentence tells nothing about it
    nxt = s[k]
    back = i - 1
    while back > 0 and not (s[back].isalnum() or s[back] in ")]）%"):
        back -= 1
    prev = s[back]
    cased = bool(_CASED.match(prev)) or prev.isdigit() or prev in ")]%"
    opener = nxt in _OPEN and (nxt not in "«»" or k in opens) or (nxt == '"' and k in opens)
    capital = nxt.isupper() or nxt.istitle()
    small = nxt.islower()
    caseless = nxt.isalpha() and not capital and not small
    if small and _CAMEL.match(s, k):
        capital, small = True, False
    if any(c in CJK_END for c in cluster):
        return (cased and gap and (capital or opener)) if quoted else True
    if any(c in OWN_END for c in cluster):
        return gap if quoted else nxt not in ",،;:"
    if small or not (capital or caseless or opener or nxt.isdigit()):
        return False
    if ";" in cluster:
        return cluster == ";" and bool(_GREEK.search(s, since, i)) and not nxt.isdigit() and not quoted
    if quoted and not cased:
        return False
    if "…" in cluster or ".." in cluster:
        return not nxt.isdigit() and cased and (capital or opener or gap)
    if cluster != ".":
        return gap or not nxt.isdigit()
    # a single period
    if quoted or s[i - 1] in ")]%" or not s[i - 1].isalnum() and not regex.match(r"\p{M}", s[i - 1]):
        return gap or capital or opener or caseless
    m = _TOKEN.match(s, first, i)
    token = m[0] if m else prev
    if token.isdigit():
        if not gap and nxt.isdigit():
            return False
        word = _WORD.match(s, k)
        if len(token) <= 2 and word and glyphs(word[0]).lower() in MONTH:
            return False
        return not (nxt.isdigit() and len(token) <= 2 and regex.match(r"\d{1,2}\.", s[k : k + 3]))
    if not gap:
        if nxt.isdigit() or (caseless and not cased and not opener):
            return False
    key = glyphs(token).lower()
    last = key.rpartition(".")[2]
    if not _CASED.search(token) and token.isalpha() and len(token) == 1:
        return False  # a title of one letter
    if len(token) == 1 and token.isupper():  # an initial, or the last letter of a vehicle's designation
        before = _AFTER_MARK.match(s, first, i)
        return gap and bool(_DESIGNATION.match(s, first, i) or (before and doc.kind(glyphs(before[1]).lower()) == MARK_KIND))
    said = doc.says(key) if len(key) > 1 else None
    if said is False and capital:
        return True
    kind = doc.kind(key)
    if kind in (NEVER_KIND, MARK_KIND):
        return False
    if kind == MAYBE_KIND or (kind == WORD_KIND and not said):
        return True
    if len(token) == 1 and token.isalpha():
        return False
    if said:
        return not nxt.isdigit() and not doc.name((_WORD.match(s, k) or [""])[0])
    if "." in token and len(last) == 1:
        return gap and not doc.name((_WORD.match(s, k) or [""])[0])
    return True


def sentence_starts(text: str, doc: _Document | None = None) -> list[int]:
    """Offsets of the first character of each sentence that isn't a blank or a list mark, in code points of ``text``.

    Empty and blank texts have none. Any length is processed in one pass.
    """
    doc = doc or _Document([text], {})
    s, at = _shadow(text)
    starts: list[tuple[int, int]] = []
    for a, b in _blocks(s):
        first = next((x for x in range(a, b) if not s[x].isspace()), None)
        if first is None:
            continue
        starts.append((first, a))
        outer, opens = _spans(s, a, b)
        from_ = [p[0] for p in outer]
        cuts: list[tuple[int, int]] = []
        for m in _END.finditer(s, first, b):
            i, stop = m.span()
            j, quoted = stop, False
            if (x := bisect_right(from_, i) - 1) >= 0 and outer[x][1] > i:
                end = outer[x][1]
                if any(c not in _CLOSERS and not c.isspace() for c in s[stop:end]):
                    continue
                j, quoted = end + 1, True
            while j < b:
                if c := _CITE.match(s, j, b):
                    j = c.end()
                elif s[j] in _CLOSERS and j not in opens:
                    j += 1
                else:
                    break
            k = j
            while k < b and s[k].isspace():
                k += 1
            if k < b and k > first and _ends(s, first, cuts[-1][0] if cuts else first, i, stop, j, k, quoted, opens, doc):
                cuts.append((k, j))
        for m in _THAI_BLANK.finditer(s, first, b):
            if (x := bisect_right(from_, m.start()) - 1) < 0 or outer[x][1] < m.start():
                cuts.append((m.end(), m.start()))
        starts += sorted(set(cuts))
    if at is None:
        return [k for k, _ in starts]
    out = []
    for k, low in starts:
        i = x = at[k]
        while x > 0 and x > at[min(low, k)] and not text[x - 1].isspace():
            x -= 1  # ignorables that stand before the first letter belong to it, if a blank is before them
        out.append(x if x > 0 and text[x - 1].isspace() else i)
    return out


def split_sentences(text: str, doc: _Document | None = None) -> list[tuple[int, str]]:
    if not (starts := sentence_starts(text, doc)):
        return []
    return [(a, regex.sub(r"[^\S\n]*[\r\n]+\s*(?:(?:[-–*•‣◦▪●○·]|\d{1,3}[.)])\s*)?$", "", text[a:b]).rstrip()) for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


def period_counts(texts: DataFrame) -> DataFrame:
    """(token, n, ends, inner, marks): tokens in small letters, how often they have a period, and how often that is at the end of a text or paragraph, before a
    small letter or a mark, and before a single capital letter without a period.

    ``texts`` has a column ``text``. Counted over the whole corpus, combined in each task before the shuffle.
    """
    hits = F.arrays_zip(F.regexp_extract_all("text", F.lit(CORPUS_TOKEN), F.lit(1)).alias("token"), F.regexp_extract_all("text", F.lit(CORPUS_TOKEN), F.lit(2)).alias("then"))
    one = texts.select(F.inline(hits)).select(F.lower("token").alias("token"), F.trim(F.col("then"), F.lit(" \t\r\n\u00a0")).alias("then"))
    first = F.substring("then", 1, 1)
    return one.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("then") == "").alias("ends"),
        F.count_if(first.isin(*",:;)]") | ((first == F.lower(first)) & (first != F.upper(first)))).alias("inner"),
        F.count_if((F.length("then") == 1) & (first != F.lower(first))).alias("marks"),
    )


def token_kinds(counts: DataFrame, expected: float = 5.0, few: float = 0.1, inner: float = 0.3, least: int = 8, marks: float = 0.01) -> DataFrame:
    """(token, kind) of what the corpus tells.

    If tokens ended texts at random, each would do so in the corpus' share of its periods. One of which ``expected`` ends are expected, but at most the share
    ``few`` of them are seen, never ends a sentence (``mark`` if a single letter follows it in the share ``marks`` or more). Others may end one if the share
    ``inner`` of ``least`` or more stands inside sentences. Words are kept only where the table says otherwise. Shares are of the corpus at any size.
    """
    total = counts.agg((F.sum("ends") / F.sum("n")).alias("p"))
    expect = F.col("p") * F.col("n")
    never = (expect >= expected) & (F.col("ends") <= few * expect)
    kind = (
        F.when(never & (F.col("marks") >= marks * F.col("n")), MARK_KIND)
        .when(never, NEVER_KIND)
        .when((F.col("n") >= least) & (F.col("inner") >= inner * F.col("n")), MAYBE_KIND)
        .when((expect >= expected) & F.col("token").isin(*sorted(NEVER | MAYBE)), WORD_KIND)
    )
    return counts.join(F.broadcast(total)).select("token", kind.alias("kind")).where("kind is not null")


def with_kinds(docs: DataFrame, learned: DataFrame | None, few: int = FEW) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``kinds`` and the learned tokens for a broadcast: one of both is empty. Up to ``few`` are sent to the tasks, more are joined with the tokens of each record."""
    none = docs.withColumn("kinds", F.lit(None).cast("array<struct<token:string,kind:string>>"))
    if learned is None:
        return none, {}
    if learned.count() <= few:
        return none, {glyphs(r.token).lower(): r.kind for r in learned.toLocalIterator()}
    tokens = docs.select("src", "record_id", F.explode("texts").alias("text")).select("src", "record_id", F.explode(F.regexp_extract_all("text", F.lit(CORPUS_TOKEN), F.lit(1))).alias("token"))
    asked = tokens.select("src", "record_id", F.lower("token").alias("token")).distinct()
    found = asked.join(learned, "token").groupBy("src", "record_id").agg(F.collect_list(F.struct("token", "kind")).alias("kinds"))
    return docs.join(found, ["src", "record_id"], "left"), {}


def sentences(docs: DataFrame, learned: DataFrame | None = None, text: bool = True, few: int = FEW) -> DataFrame:
    """(src, record_id, item_no, sentence_no, start_char, and with ``text`` sentence) of every text in ``docs``: (src, record_id, texts array<string>).

    The texts of one record are one document. ``learned`` is (token, kind). Null, empty and blank texts have no sentences; nulls keep their
    item_no. Equal rows give equal sentences. One map pass; records aren't moved unless more than ``few`` tokens are learned.
    """
    rows_, kinds_ = with_kinds(docs.select("src", "record_id", "texts"), learned, few)
    known = docs.sparkSession.sparkContext.broadcast(kinds_)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for src, rid, texts, kinds in b.itertuples(index=False, name=None):
                if texts is None:
                    continue
                doc = _Document([t for t in texts if t], known.value if kinds is None else {glyphs(x["token"]).lower(): x["kind"] for x in kinds})
                for no, t in enumerate(texts):
                    if t and text:
                        rows += [(src, rid, no, n, at, x) for n, (at, x) in enumerate(split_sentences(t, doc))]
                    elif t:
                        rows += [(src, rid, no, n, at) for n, at in enumerate(sentence_starts(t, doc))]
            yield pd.DataFrame(rows, columns=columns)

    columns = ["src", "record_id", "item_no", "sentence_no", "start_char"] + ["sentence"] * text
    schema = "src string, record_id bigint, item_no bigint, sentence_no int, start_char bigint" + ", sentence string" * text
    return rows_.select("src", "record_id", "texts", "kinds").mapInPandas(run, schema)


def statement_documents(segments: DataFrame, tanks: DataFrame) -> DataFrame:
    a = spread(segments.select("segment_id", "text")).select(F.lit("segment").alias("src"), F.col("segment_id").alias("record_id"), F.array("text").alias("texts"))
    b = spread(tanks.select("row_id", "strategies")).select(F.lit("strategies").alias("src"), F.col("row_id").alias("record_id"), F.col("strategies").alias("texts"))
    return a.unionAll(b)


def statements(segments: DataFrame, tanks: DataFrame, text: bool = True) -> DataFrame:
    docs = statement_documents(segments, tanks)
    learned = token_kinds(period_counts(docs.select(F.explode("texts").alias("text")).where("text is not null"))).persist(StorageLevel.MEMORY_AND_DISK)
    return sentences(docs, learned, text)
