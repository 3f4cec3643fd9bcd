"""Template residue and error-page text.

Records of one template differ only in its slots. The records of a site are laid side by side: blocks that they share are the
template's own, and so are lines whose form density finds outside the body all over the corpus (``lines``); what is left of a record are its
slots. A slot that keeps a variable or nothing is residue at once. Defaults, filler and messages are learned: what fills the slots of
records that hold little else is told from what fills the slots of all others, first by length and then by what was learned itself. Whole
records that come back under many addresses are error pages of any length. A record is excluded if all its slots are residue.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markup import block_texts
from ..sources import spread
from .lines import Learned, Lines, tidy

# Forms of variables that a template engine left in place.
VARIABLE = re.compile(
    r"\{%.*?%\}|<%=?.*?%>|[#$]\{[^{}]*\}|\{\{\{?[^{}]*\}?\}\}|\{[\w.\s-]{1,40}\}|%[\w.]+%|\[\[[\w.]+\]\]|\[[\w.]+ here\]|@@[\w.]+@@|__[\w.]+?__(?!\w)|<insert [\w. ]+>|\[object Object\]|\bundefined\b|\bnull\b|\bNaN\b"
)
# Labels that stand before a slot.
LABELS = re.compile(r"(?:by|von|par|от|tier|stufe|name|author|title|date)\s*:?|[\s,.:;|·/()\"'*-]+", re.I)
_MAYBE_VARIABLE, _DIGIT = re.compile(r"[{%\[@<_]|undefined|null|NaN"), re.compile(r"\d")
_NUMBER = re.compile(r"\b[0-9a-f]*\d[0-9a-f]*\b", re.I)
_CALL = re.compile(r"[\w.]+\(\)")
_SITE = re.compile(r"(?<=[a-zа-я,] )[A-ZА-Я][\w-]+(?=[ .,]|$)")
_UNSPACED = re.compile(r"[一-鿿぀-ヿ]+")
_WORDS = re.compile(r"[^\W\d_一-鿿぀-ヿ]+")
#: Words and whole slots are counted in this many buckets, so that what is learned has one size for any corpus.
BUCKETS = 1 << 20


def is_json(body: str) -> bool:
    return body.lstrip()[:1] in ("{", "[") and not body.lstrip()[:2] in ("{{", "[[", "{%")


def is_html(body: str) -> bool:
    return bool(not is_json(body) and re.search(r"<(?:!doctype|/?[a-z][a-z0-9]*[\s>/])", body, re.I))


def _strings(value, key: str = "") -> Iterator[str]:
    if isinstance(value, dict):
        for k, v in value.items():
            yield from _strings(v, k)
    elif isinstance(value, list):
        for v in value:
            yield from _strings(v, key)
    elif isinstance(value, str) and key not in ("title", "code", "type", "contentmodel", "contentformat", "timestamp", "url", "user"):
        yield value


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def texts(body: str) -> list[str]:
    """The tidy blocks or lines of a body, whatever its kind."""
    if is_json(body):
        try:
            values = list(_strings(json.loads(body)))
        except ValueError:
            values = re.findall(r'"(?:content|info|text|\*)"\s*:\s*"((?:[^"\\]|\\.)*)', body)
        return [x for t in values for x in t.split("\n") if x.strip()]
    return [tidy(t) for t in (block_texts(body) if is_html(body) else body.splitlines())]


def phrase(text: str) -> str:
    """The phrase that a tidy text repeats from its start to its end, or the text."""
    words = text.split(" ")
    if words[0] not in words[1:]:
        return text
    back = [0] * len(words)  # of each start of the text: how long its longest other start is that it also ends with
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = back[k - 1]
        k += words[i] == words[k]
        back[i] = k
    n = len(words) - k
    return " ".join(words[:n]) if len(words) % n == 0 else text


@lru_cache(100_000)
def shape(slot: str) -> str:
    """A slot without variables, numbers and the names in it; repeats of one phrase count once. Empty if nothing else is left."""
    had = _MAYBE_VARIABLE.search(slot) and VARIABLE.search(slot)
    rest = tidy(VARIABLE.sub(" ", slot)) if had else tidy(slot)
    if had and not LABELS.sub("", rest):
        return ""
    rest = _SITE.sub("N", _CALL.sub("f()", phrase(rest)))
    return _NUMBER.sub("0", rest) if _DIGIT.search(rest) else rest


@lru_cache(100_000)
def units(form: str) -> tuple[int, ...]:
    """Buckets of a shape's different words (pairs of letters, in scripts without blanks), and of the shape as a whole."""
    low = form.lower()
    words = set(_WORDS.findall(low))
    for run in _UNSPACED.findall(low):
        words.update(run[i : i + 2] for i in range(max(len(run) - 1, 1)))
    return tuple(sorted({crc32(w.encode("utf-8", "replace")) % BUCKETS for w in (*words, "= " + form)}))


def slots(body: str, lines: Lines) -> list[str]:
    """Shapes of what a record holds apart from lines that look like what sites put around their texts. Lines of JSON bodies all count."""
    found = texts(body)
    return [shape(x) for x, around in zip(found, [False] * len(found) if is_json(body) else lines.all_furniture(found), strict=True) if not around]


#: Ids of at most this many rows are sent to the tasks, more are joined by a shuffle.
FEW_IDS = 1_000_000


def later(rows: DataFrame, *same: str) -> DataFrame:
    """(fetch_id) of the rows that equal a row of a lesser id in the columns ``same``. Only ids and these columns are shuffled."""
    firsts = rows.groupBy(*same).agg(F.min("fetch_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    return rows.select("fetch_id", *same).join(firsts, [*same]).where("fetch_id > first").select("fetch_id")


def without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without those of the ids; the rows themselves are only shuffled if the ids are many."""
    kept = ids.persist(StorageLevel.MEMORY_AND_DISK)
    return rows.join(F.broadcast(kept) if kept.count() <= FEW_IDS else kept, "fetch_id", "left_anti")


def without_copies(bodies: DataFrame) -> DataFrame:
    """Rows of different bodies, those of the least ids; null bodies all stay."""
    seen = bodies.where("body is not null").select("fetch_id", F.xxhash64("body").alias("digest"), F.length("body").alias("chars"))
    return without(bodies, later(seen, "digest", "chars"))


def with_address(fetched: DataFrame) -> DataFrame:
    """With (host, address, slug): of the url without scheme, query, fragment and last slash, in small letters; without an url, no host and the body's digest.

    ``slug`` is the last part of an address.
    """
    if "url" not in fetched.columns:
        fetched = fetched.withColumn("url", F.lit(None).cast("string"))
    plain = F.regexp_replace(F.lower(F.trim("url")), r"^[a-z]+://(?:www\.)?|[?#].*|/+(?=$|[?#])", "")
    given = plain != ""
    return fetched.select(
        *[c for c in fetched.columns if c != "url"],
        F.nullif(F.substring_index(plain, "/", 1), F.lit("")).alias("host"),
        F.when(given, F.xxhash64(plain)).otherwise(F.xxhash64("body")).alias("address"),
        F.when(given, F.xxhash64(F.substring_index(plain, "/", -1))).otherwise(F.xxhash64("body")).alias("slug"),
    )


def read_slots(bodies: DataFrame, learned: Learned) -> DataFrame:
    """(fetch_id, host, address, slug, whole, slots array<struct<form, units>>) of the bodies that aren't null, empty or blank.

    ``form`` is the digest of a slot's shape, 0 if only variables and labels are in it; ``whole`` tells records of other blocks apart, null for JSON.
    """
    judge = learned.judge()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms, flat, whole = [], [], []
            unit_ends, slot_ends = [0], [0]
            for body, ids, shares in zip(*(b.column(c).to_pylist() for c in ("body", "known_forms", "known_shares")), strict=True):
                found = slots(body, judge(ids, shares))
                whole.append(None if is_json(body) else digest("\n".join(sorted(set(found)))))
                for s in found:
                    forms.append(digest(s) if s else 0)
                    flat += units(s) if s else ()
                    unit_ends.append(len(flat))
                slot_ends.append(len(forms))
            lists = pa.ListArray.from_arrays(pa.array(unit_ends, pa.int32()), pa.array(flat, pa.int32()))
            structs = pa.StructArray.from_arrays([pa.array(forms, pa.int64()), lists], ["form", "units"])
            made = [pa.array(whole, pa.int64()), pa.ListArray.from_arrays(pa.array(slot_ends, pa.int32()), structs)]
            kept = ["fetch_id", "host", "address", "slug"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *made], names=[*kept, "whole", "slots"])

    real = bodies.where(F.col("body").isNotNull() & F.col("body").rlike(r"(?U)\S"))
    asked = learned.beside(real, "fetch_id", "body", texts).select("fetch_id", "host", "address", "slug", "body", "known_forms", "known_shares")
    return asked.mapInArrow(run, "fetch_id bigint, host string, address bigint, slug bigint, whole bigint, slots array<struct<form:bigint,units:array<int>>>")


def site_forms(read: DataFrame, least: int = 8, share: float = 0.3) -> DataFrame:
    """(host, site array<bigint>): what the records of a site have in common when they are laid side by side.

    A form is the template's own if it is in ``least`` records of the site and in the share ``share`` of them, where records count as different only
    by their addresses and by what else they hold, whichever are fewer: copies of one page count once, and so does one page
    fetched again and again. A site has at most (forms of a page) / share of them. JSON bodies have no template of a site. A record without an
    address has no site.
    """
    pages = read.where("host is not null and whole is not null")
    seen = pages.select("host", "address", "whole", F.explode(F.array_distinct(F.array_append(F.transform("slots", lambda s: s["form"]), F.lit(0)))).alias("form"))
    counts = seen.groupBy("host", "form").agg(F.least(F.countDistinct("address"), F.countDistinct("whole")).alias("n"))
    common = F.collect_list(F.when((F.col("form") != 0) & (F.col("n") >= least), F.struct("form", "n")))
    per = counts.groupBy("host").agg(F.max(F.when(F.col("form") == 0, F.col("n"))).alias("pages"), common.alias("forms"))
    kept = F.filter("forms", lambda x: x["n"] >= share * F.col("pages"))
    return per.select("host", F.transform(kept, lambda x: x["form"]).alias("site")).where(F.size("site") > 0)


def induced(read: DataFrame, small: int = 20_000) -> DataFrame:
    """``read`` with only the slots that aren't their site's own, and ``page``, which tells a record by its different slots (null if all are empty)."""
    sites = site_forms(read).persist(StorageLevel.MEMORY_AND_DISK)
    joined = read.join(F.broadcast(sites) if sites.count() <= small else sites, "host", "left")
    own = F.col("site").isNotNull() & F.col("whole").isNotNull()
    joined = joined.withColumn("slots", F.when(own, F.filter("slots", lambda s: ~F.array_contains("site", s["form"]))).otherwise(F.col("slots")))
    forms = F.array_sort(F.array_distinct(F.filter(F.transform("slots", lambda s: s["form"]), lambda f: f != 0)))
    return joined.select("fetch_id", "address", "slug", "slots", F.when(F.size(forms) > 0, F.xxhash64(forms)).alias("page"))


class Odds:
    """Log odds of each bucket between the records that hold nothing but residue and all others; 0 for what one record has, and where there are hardly others to tell from."""

    def __init__(self, lone: np.ndarray, rest: np.ndarray, n_lone: int, n_rest: int, least: int = 2, others: int = 8):
        overall = (lone + rest) / max(n_lone + n_rest, 1)
        odds = np.log(np.maximum(lone + overall, 1e-12) / (n_lone + 1)) - np.log((rest + 0.5) / (n_rest + 1))
        self.odds = np.where((lone + rest >= least) & (n_rest >= others), odds, 0.0).astype(np.float32)

    def residue(self, records: pa.ListArray, least: float) -> np.ndarray:
        """Of each record, given by its slots' buckets, whether every slot is empty or speaks for residue."""
        slots_ = records.flatten()
        of_record, of_slot = (np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy(zero_copy_only=False))]).astype(np.int64) for x in (records, slots_))
        summed = np.concatenate([[0.0], np.cumsum(self.odds[slots_.flatten().to_numpy(zero_copy_only=False)], dtype=np.float64)])
        other = np.concatenate([[0], np.cumsum((np.diff(of_slot) > 0) & (np.diff(summed[of_slot]) <= least))])
        return np.diff(other[of_record]) == 0


def _odds(records: DataFrame, lone) -> Odds:
    """Counted over all records, in buckets: sums of each task before the shuffle, and no more rows than buckets for the driver."""
    one = records.where(F.size("slots") > 0).select(lone.alias("lone"), F.array_distinct(F.flatten(F.transform("slots", lambda s: s["units"]))).alias("units"))
    counts = one.select("lone", F.explode(F.array_append("units", F.lit(-1))).alias("unit")).groupBy("unit").agg(F.sum(F.col("lone").cast("long")).alias("lone"), F.count("*").alias("n")).toArrow()
    lone_, all_ = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    at = counts["unit"].to_numpy()
    lone_[at], all_[at] = counts["lone"].to_numpy(), counts["n"].to_numpy()  # -1, the number of records, is the last
    return Odds(lone_[:-1], (all_ - lone_)[:-1], int(lone_[-1]), int(all_[-1] - lone_[-1]))


def _says(odds, least: float):
    @F.arrow_udf("boolean")
    def says(records: pa.Array) -> pa.Array:
        return pa.array(odds.value.residue(records, least))

    return says


def residue_ids(fetched: DataFrame, learned: Learned, short: int = 48, pages: int = 8, rounds: int = 2, least: float = 1.0) -> DataFrame:
    """(fetch_id) of the records without content of their own. ``fetched`` is (fetch_id, url, body).

    Odds are counted over all records, one of each address, so that copies teach nothing. In the first round a record counts as one that may hold nothing but
    residue if it has at most ``short`` different words, in the next ones if the round before says so, at any length; the last one decides. ``least`` is
    the log odds that a slot must exceed. A whole record found under ``pages`` different last parts of an address is a template too (copies of an
    article keep theirs). Null, empty and blank bodies are no cases. Repeated rows have their own ids and are judged alike. An empty table has none.
    """
    read = induced(read_slots(with_address(fetched), learned).persist(StorageLevel.MEMORY_AND_DISK))  # pages are read once; what follows is cheap
    spark = fetched.sparkSession
    one = without(read, later(read, "address")).select("slug", "slots", "page")
    buckets = F.transform("slots", lambda s: s["units"])
    lone = F.size(F.array_distinct(F.flatten(buckets))) <= short
    for _ in range(rounds):
        lone = _says(spark.sparkContext.broadcast(_odds(one, lone)), least)(buckets)
    often = one.where("page is not null").groupBy("page").agg(F.countDistinct("slug").alias("slugs")).where(F.col("slugs") >= pages).select("page", F.lit(True).alias("often")).persist(StorageLevel.MEMORY_AND_DISK)
    return read.join(F.broadcast(often) if often.count() <= FEW_IDS else often, "page", "left").where(F.coalesce("often", F.lit(False)) | lone).select("fetch_id")


def residue_records(fetched: DataFrame) -> DataFrame:
    """(fetch_id) of the records without content of their own; repeated rows have their own ids and are judged alike."""
    from .boilerplate import line_forms

    bodies = spread(fetched.select("fetch_id", "body", *{"url"} & {*fetched.columns}))
    return residue_ids(bodies, line_forms(bodies))
