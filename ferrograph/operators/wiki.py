"""Recorded API payloads to revisions, and revisions to vehicles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import vocab, wikitext
from ..functions.text import canonical, category_leaf, identity, identity_text, nation, nation_from_category, primary_class, tank_suffix, tier_from_category, wiki_title
from .taxonomy import only, resolve_class

_PAGE = (
    "struct<pageid:bigint,title:string,missing:string,pageprops:struct<displaytitle:string>,categories:array<struct<title:string>>,"
    "revisions:array<struct<content:string,`*`:string,slots:struct<main:struct<content:string,`*`:string>>>>>"
)
#: A name that a vehicle may have.
IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9_.-]*\z"
NO_TEXTS = "array<string>"


def revisions(payloads: DataFrame, key: str = "fetch_id", body: str = "body") -> DataFrame:
    """(key, page_id, title, text, code, display_title, categories): one row a page of each JSON payload; ``code`` says why there is no text.

    Pages may be a list or a map, the text in a slot or in the revision itself. A payload of an API error gives one row without
    page. Bodies that aren't JSON objects, null ones included, give none. Each body is parsed once.
    """
    own = payloads.where(F.col(body).rlike(r"^\s*\{")).select(F.col(key).alias(key), F.try_parse_json(body).alias("v")).where("v is not null")
    listed = F.try_variant_get("v", "$.query.pages", f"array<{_PAGE}>")
    mapped = F.map_values(F.try_variant_get("v", "$.query.pages", f"map<string,{_PAGE}>"))
    error = F.coalesce(F.try_variant_get("v", "$.error.code", "string"), F.try_variant_get("v", "$.error.info", "string"))
    found = F.filter(F.coalesce(listed, mapped), lambda p: p.isNotNull())
    rows = own.select(key, error.alias("error"), F.explode_outer(found).alias("p")).where("p is not null or error is not null")
    r = F.get(F.col("p.revisions"), 0)
    text = F.coalesce(r["slots"]["main"]["content"], r["slots"]["main"]["*"], r["content"], r["*"])
    code = F.when(F.col("error").isNotNull(), F.lit("api_error")).when(F.col("p.missing").isNotNull(), F.lit("missing_page")).when(text.isNull(), F.lit("missing_revision"))
    titles = F.filter(F.transform(F.col("p.categories"), lambda c: c["title"]), lambda t: F.trim(t) != "")
    return rows.select(
        key, F.col("p.pageid").alias("page_id"), F.col("p.title").alias("title"), text.alias("text"), code.alias("code"),
        F.col("p.pageprops.displaytitle").alias("display_title"), F.coalesce(titles, F.array().cast(NO_TEXTS)).alias("categories"),
    )


def redirects(payloads: DataFrame, body: str = "body") -> DataFrame:
    """(source, target) of the redirects and normalizations that payloads report, by normalized title, distinct."""
    pair = "array<struct<`from`:string,`to`:string>>"
    v = payloads.where(F.col(body).rlike(r"^\s*\{")).select(F.try_parse_json(body).alias("v"))
    both = F.concat(*[F.coalesce(F.try_variant_get("v", f"$.query.{x}", pair), F.array().cast(pair)) for x in ("normalized", "redirects")])
    rows = v.select(F.explode(both).alias("x")).select(wiki_title(F.col("x.from")).alias("source"), wiki_title(F.col("x.to")).alias("target"))
    return rows.where("source is not null and target is not null").distinct()


def _value(params: list[tuple[str, str]], names: list[str]) -> tuple[str | None, bool]:
    """Visible value of the first of the names that is given (none if that is empty), and whether any two of those given contradict each other."""
    given = [(n, wikitext.single_line(v)) for n in names for k, v in params if k == n]
    return (given[0][1] or None) if given else None, len({identity_text(v) for _, v in given}) > 1


def read_vehicle(text: str | None) -> tuple:
    """(code, identifier, display name, class, nation, tier, categories, sections, empty sections) as a page's markup states them; ``code`` if its boxes don't allow to read it."""
    boxes = [params for name, params in wikitext.every_template(text or "") if name in vocab.INFOBOXES or name.removeprefix("infobox ") in vocab.INFOBOXES]
    linked = wikitext.categories(text or "")
    if len(boxes) != 1:
        return ("competing_vehicle_infoboxes" if boxes else "non_vehicle_candidate", *[None] * 5, linked, [], 0)
    read = [_value(boxes[0], names) for names in vocab.INFOBOX_FIELDS.values()]
    if any(conflict for _, conflict in read):
        return ("conflicting_infobox_parameters", *[None] * 5, linked, [], 0)
    found = wikitext.sections(text, {"performance", "tactics"})
    if not any(body for _, _, body in found):  # pages that keep them in fields of the box
        told = [(title, next((v for n in names for k, v in boxes[0] if k == n), None)) for title, names in vocab.INFOBOX_SECTIONS.items()]
        found += [(title, 2, wikitext.body_blocks(v)) for title, v in told if v is not None]
    full = [x for x in found if x[2]]
    return (None, *[v for v, _ in read], linked, full, len(found) - len(full))


def vehicles(revs: DataFrame, evidence: DataFrame | None = None, key: str = "fetch_id") -> DataFrame:
    """(key, title, status, code, warnings, name, display_name, class, subclasses, nation, tier, sections) of revisions.

    The page's markup is read in Python; everything decided about it is columns, in which the first rule that fails gives the code. ``evidence`` is what a taxonomy says of page
    titles. A revision that couldn't be read is rejected with its own code. A stub without metadata that is marked for maintenance isn't a vehicle.
    """
    sections = "array<struct<title:string,level:int,text:string>>"
    types = f"`{key}` bigint, title string, fetched string, display_title string, listed array<string>, read string, identifier string, shown string, class_text string, nation_text string, tier_text string, linked array<string>, sections {sections}, empty int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, t, c, d, list(l), *(read_vehicle(x) if c is None else ("", *[None] * 5, [], [], 0))) for k, t, c, d, l, x in b.itertuples(index=False, name=None)]
            yield pd.DataFrame(rows, columns=[x.split(" ")[0].strip("`") for x in types.split(", ")])

    parsed = revs.select(key, "title", "code", "display_title", "categories", "text").mapInPandas(run, types)
    none = F.array().cast(NO_TEXTS)
    if evidence is None:
        joined = parsed.select("*", none.alias("direct"), none.alias("path_classes"), none.alias("subclasses"))
    else:
        known = evidence.groupBy(F.col("title").alias("_page")).agg(F.array_distinct(F.flatten(F.collect_list("categories"))).alias("direct"), F.array_distinct(F.flatten(F.collect_list("classes"))).alias("path_classes"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("subclasses")))).alias("subclasses"))
        joined = parsed.join(known, wiki_title(F.col("title")) == F.col("_page"), "left").drop("_page")
        joined = joined.select(*[c for c in joined.columns if c not in ("direct", "path_classes", "subclasses")], *[F.coalesce(c, none).alias(c) for c in ("direct", "path_classes", "subclasses")])
    # categories of all three kinds are folded once a distinct value, in a join of a row a category
    each = joined.select(key, F.explode(F.array_distinct(F.concat("direct", "listed", "linked"))).alias("category"))
    c = F.col("category")
    told = each.select(key, primary_class(c).alias("class"), nation_from_category(c).alias("nation"), tier_from_category(c).alias("tier"), (category_leaf(c) == vocab.MAINTENANCE).alias("stub"))
    sets = told.groupBy(key).agg(F.collect_set("class").alias("own_classes"), F.collect_set("nation").alias("nations"), F.collect_set("tier").alias("tiers"), F.bool_or("stub").alias("stub"))
    full = joined.join(sets, key, "left").select(
        *joined.columns, F.coalesce("own_classes", none).alias("own_classes"), F.coalesce("nations", none).alias("nations"), F.coalesce("tiers", F.array().cast("array<int>")).alias("tiers"), F.coalesce("stub", F.lit(False)).alias("stub"),
        tank_suffix(canonical(F.replace("title", F.lit("_"), F.lit(" ")))).alias("suffix"), primary_class(F.col("class_text")).alias("box_class"), nation(F.col("nation_text")).alias("box_nation"),
    )
    fallback = F.replace("suffix", F.lit(" "), F.lit("_"))
    valid = F.coalesce(F.col("identifier").rlike(IDENTIFIER), F.lit(False))
    cls, class_code, class_warning = resolve_class(F.array_sort(F.array_union("path_classes", "own_classes")), F.col("class_text"), F.col("box_class"))
    one_nation, no_nation = only(F.col("nations"), "missing_nation", "contradictory_taxonomy_nations")
    one_tier, no_tier = only(F.col("tiers"), "missing_tier", "contradictory_taxonomy_tiers")
    given_tier = F.when(F.col("tier_text").rlike(r"^[0-9]+\z"), F.expr("try_cast(tier_text as int)"))
    display = F.coalesce(F.col("shown"), F.nullif(canonical("display_title"), F.lit("")), F.col("suffix"))
    code = F.coalesce(
        "fetched", "read",
        F.when(~valid & F.col("suffix").isNull(), F.lit("missing_vehicle_identifier")),
        F.when(~valid & ~fallback.rlike(IDENTIFIER), F.lit("invalid_vehicle_identifier")),
        F.when(display.isNull(), F.lit("missing_display_name")),
        class_code,
        F.when(F.col("nation_text").isNull(), no_nation).when(F.col("box_nation").isNull(), F.lit("unknown_nation")),
        F.when(F.col("tier_text").isNull(), no_tier).when(F.coalesce(~given_tier.between(1, 10), F.lit(True)), F.lit("invalid_tier")),
    )
    incomplete = code.isin("missing_primary_class", "missing_nation", "missing_tier") & F.col("stub")
    code = F.when(incomplete, F.lit("incomplete_vehicle_page")).otherwise(code)
    status = F.when(code.isNull(), "accepted").when(code.isin("non_vehicle_candidate", "incomplete_vehicle_page"), "non_vehicle").otherwise("rejected")
    warnings = F.filter(
        F.array(
            F.when(~valid & F.col("identifier").isNotNull(), F.lit("invalid_infobox_identifier_fallback")), class_warning,
            F.when(F.col("nation_text").isNull(), F.lit("infobox_nation_fallback")), F.when(F.col("tier_text").isNull(), F.lit("infobox_tier_fallback")),
            F.when(F.col("empty") > 0, F.lit("empty_tactical_section")),
        ),
        lambda w: w.isNotNull(),
    )
    ok = code.isNull()
    kept = lambda c, name: F.when(ok, c).alias(name)
    return full.select(
        key, "title", status.alias("status"), code.alias("code"), F.when(ok, warnings).otherwise(none).alias("warnings"), kept(F.when(valid, F.col("identifier")).otherwise(fallback), "name"), kept(display, "display_name"),
        kept(cls, "class"), kept(F.col("subclasses"), "subclasses"), kept(F.coalesce("box_nation", one_nation), "nation"), kept(F.coalesce(given_tier, one_tier), "tier"), kept(F.col("sections"), "sections"),
    )


def unique_vehicles(found: DataFrame, key: str = "fetch_id") -> DataFrame:
    """Accepted vehicles with ``kept``: of each identity of a name the first by (name, title, key), each in sort order. The others are the side output.

    The first is found by a combining minimum and joined back, one row an identity; vehicles that share a name are few by the contract.
    """
    keyed = found.where("status = 'accepted'").withColumn("_id", identity(F.col("name"))).withColumn("_order", F.struct("_id", "name", identity(F.col("title")), "title", key))
    firsts = keyed.groupBy("_id").agg(F.min("_order").alias("_first"))
    return keyed.join(firsts, "_id").withColumn("kept", F.col("_order") == F.col("_first")).drop("_id", "_order", "_first")


def redirect_targets(redirects: DataFrame) -> DataFrame:
    """(source, target, code) of (source, target) redirects followed to their end; ``redirect_cycle`` where there is none.

    Ways are doubled in each round, so a chain of any length takes as many rounds as its length has binary digits. A title with several targets follows the least.
    """
    one = redirects.where("source is not null and target is not null").groupBy("source").agg(F.min("target").alias("target"))
    shared = one.sparkSession.sparkContext.getCheckpointDir() is not None
    keep = (lambda df: df.checkpoint()) if shared else (lambda df: df.persist())
    ways = keep(one)
    titles = ways.count()
    rounds = max(1, titles).bit_length()  # after that many doublings every chain without a cycle has ended
    for _ in range(rounds):
        on = ways.select(F.col("source").alias("target"), F.col("target").alias("next"))
        further = keep(ways.join(on, "target", "left").select("source", F.coalesce("next", "target").alias("target"), F.col("next").isNotNull().alias("open")))
        ways = further.select("source", "target")
        if not further.where("open").head(1):
            break
    # what still leads on after as many steps as there are titles is in a cycle or ends in one
    last = ways.join(one.select(F.col("source").alias("target"), F.lit(True).alias("open")), "target", "left")
    return last.select("source", F.when(F.col("open").isNull(), F.col("target")).alias("target"), F.when(F.col("open"), F.lit("redirect_cycle")).alias("code"))


def ordered_evidence(*lists) -> Column:
    """Categories of several lists, the first spelling of each identity at its first place, as one column; folded in the row."""
    return _first_spellings(F.concat(*[F.coalesce(x, F.array().cast(NO_TEXTS)) for x in lists]))


@F.pandas_udf(ArrayType(StringType()))
def _first_spellings(s: pd.Series) -> pd.Series:
    return pd.Series([list({identity_text(v.replace("_", " ")): v for v in reversed(a) if v is not None}.values())[::-1] for a in s], dtype=object)
