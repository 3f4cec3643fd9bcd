"""Queries of prose, concepts, guides, taxonomy and recorded pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import addresses, text, vocab
from ..operators import guides, prose, records, taxonomy, wiki
from ..sources import fetching, read_table, spread
from .unicode_sql import identity_ctes

ROOT = "Category:Vehicles"


def _segments(spark, sf_dir):
    return read_table(spark, sf_dir, "strategy_segments", "segment_id", "text", "source_kind", "tank_name")


def identity_names(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "tanks_data", "row_id", "display_name")).select("row_id", text.canonical(F.col("display_name")).alias("canonical"), text.identity(F.col("display_name")).alias("identity"))


def identity_ascii(spark, sf_dir):
    return read_table(spark, sf_dir, "category_members", "title").distinct().select("title", text.ascii_identity(F.col("title")).alias("identity"))


def segment_blocks(spark, sf_dir):
    return _segments(spark, sf_dir).select("segment_id", F.posexplode(prose.blocks(F.col("text"))).alias("block_no", "block"))


def segment_sentences(spark, sf_dir):
    return prose.statements(_segments(spark, sf_dir), "text", "segment_id")


def tactical_statements(spark, sf_dir):
    return segment_sentences(spark, sf_dir).where(prose.is_tactical(F.col("statement"))).select("segment_id", "block_no", "sentence_no")


def precedence_kept(spark, sf_dir):
    rows = _segments(spark, sf_dir).where("text is not null").withColumn("statement", text.normalize_statement(F.col("text")))
    return prose.deduplicated(rows, ["segment_id"]).select("identity", "segment_id", "rank")


def alias_concepts(spark, sf_dir):
    words = read_table(spark, sf_dir, "tanks_data", "keywords").select(F.explode("keywords").alias("text"))
    texts = _segments(spark, sf_dir).select("text").unionAll(words).where("text is not null").distinct()
    return texts.select("text", F.array_join(prose.alias_concepts(F.col("text")), "|").alias("concepts")).where("concepts != ''")


def segment_concepts(spark, sf_dir):
    return segment_sentences(spark, sf_dir).select("segment_id", "block_no", "sentence_no", prose.concepts(F.col("statement")).alias("concepts"))


def concept_normalize(spark, sf_dir):
    words = read_table(spark, sf_dir, "tanks_data", "keywords").select(F.explode("keywords").alias("keyword")).where("keyword is not null").distinct()
    normal = prose.normalize_concept(F.col("keyword"))
    return words.select("keyword", normal.alias("concept"), prose.valid_keyword(normal).alias("valid"))


def guide_scope(spark, sf_dir):
    g = read_table(spark, sf_dir, "guide_segments", "guide_id", "applicable_classes")
    return g.select("guide_id", F.explode(F.array_distinct("applicable_classes")).alias("class")).where("class is not null").groupBy("class").agg(F.count("*").alias("guides"))


def scope_join(spark, sf_dir):
    r = records.latest_records(read_table(spark, sf_dir, "tanks_data"))
    return prose.scope_join(r, read_table(spark, sf_dir, "guide_segments", "guide_id", "applicable_classes"))


def scope_members(spark, sf_dir):
    return prose.scope_members(read_table(spark, sf_dir, "guide_segments", "guide_id", "applicable_classes"))


def heading_classes(spark, sf_dir):
    return read_table(spark, sf_dir, "guide_segments", "guide_id", "text").where("text is not null").select("guide_id", F.array_join(F.array_sort(prose.heading_classes(F.col("text"))), "|").alias("classes"))


def guide_elements(spark, sf_dir):
    return guides.guide_elements(spread(read_table(spark, sf_dir, "fetch_results", "fetch_id", "body")))


def guide_page_segments(spark, sf_dir):
    return guides.guide_segments(guide_elements(spark, sf_dir))


def guide_rejects(spark, sf_dir):
    return guides.page_gates(guide_elements(spark, sf_dir)).groupBy("code").agg(F.count("*").alias("pages"))


def access_documents(spark, sf_dir):
    return read_table(spark, sf_dir, "fetch_results", "fetch_id", "body").where(text.any_of(F.col("body"), vocab.ACCESS_DOCUMENT)).select("fetch_id")


def url_identity(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "fetch_results", "fetch_id", "url")).select("fetch_id", addresses.clean_address(F.col("url")).alias("url"))


def safe_url(spark, sf_dir):
    return read_table(spark, sf_dir, "fetch_results", "fetch_id", "url").select("fetch_id", text.safe_url(F.col("url")).alias("safe"))


def category_paths(spark, sf_dir):
    return taxonomy.paths(read_table(spark, sf_dir, "category_members"), ROOT).select("category", F.array_join("path", " > ").alias("path"), "depth")


def category_closure(spark, sf_dir):
    return taxonomy.closure(read_table(spark, sf_dir, "category_members"), ROOT)


def category_pages(spark, sf_dir):
    p = taxonomy.pages(read_table(spark, sf_dir, "category_members"))
    return p.select("title", "page_id", F.array_join("categories", "|").alias("categories"))


def category_evidence(spark, sf_dir):
    e = taxonomy.evidence(read_table(spark, sf_dir, "category_members"), ROOT)
    return e.select("title", "page_id", *[F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in ("classes", "subclasses", "nations", "tiers")])


def category_ancestors(spark, sf_dir):
    return taxonomy.above(read_table(spark, sf_dir, "category_members"), ROOT)


def content_categories(spark, sf_dir):
    return taxonomy.content_categories(read_table(spark, sf_dir, "category_members", "category"))


def direct_minus_children(spark, sf_dir):
    links = taxonomy.links(read_table(spark, sf_dir, "category_members"))
    return links.select(F.col("parent").alias("category")).exceptAll(links.select("child")).distinct()


def children_and_parents(spark, sf_dir):
    links = taxonomy.links(read_table(spark, sf_dir, "category_members"))
    return links.select(F.col("parent").alias("category")).intersect(links.select("child"))


def canonical_nations(spark, sf_dir):
    a = read_table(spark, sf_dir, "nation_aliases", "canonical", "alias").select(text.identity(F.col("alias")).alias("key"), "canonical").distinct()
    t = spread(read_table(spark, sf_dir, "tanks_data", "row_id", "nation")).withColumn("key", text.identity(F.col("nation")))
    # 60 spellings at every scale; without a hint, so that the optimizer checks the size itself
    return t.join(a.groupBy("key").agg(F.min("canonical").alias("canonical")), "key", "left").select("row_id", F.coalesce("canonical", "nation").alias("nation"))


def canonical_classes(spark, sf_dir):
    t = spread(read_table(spark, sf_dir, "tanks_data", "row_id", "class"))
    return t.select("row_id", text.primary_class(F.col("class")).alias("class"))


def class_decisions(spark, sf_dir):
    r = records.latest_records(read_table(spark, sf_dir, "tanks_data")).select("name", F.nullif(F.trim("class"), F.lit("")).alias("given"), text.primary_class(F.col("class")).alias("own"))
    e = taxonomy.evidence(read_table(spark, sf_dir, "category_members"), ROOT).select(F.regexp_replace("title", "^tank:", "").alias("key"), "classes").groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"))
    joined = r.join(e, text.wiki_title(F.col("name")) == F.col("key"), "left")
    cls, code, warning = taxonomy.resolve_class(F.coalesce("classes", F.array().cast("array<string>")), F.col("given"), F.col("own"))
    return joined.select("name", cls.alias("class"), code.alias("code"), warning.alias("warning"))


def _revisions(spark, sf_dir):
    return wiki.revisions(spread(read_table(spark, sf_dir, "fetch_results", "fetch_id", "body")))


def wiki_revisions(spark, sf_dir):
    return _revisions(spark, sf_dir).select("fetch_id", "page_id", "title", "text", "code")


def _vehicles(spark, sf_dir):
    return wiki.vehicles(_revisions(spark, sf_dir), taxonomy.evidence(read_table(spark, sf_dir, "category_members"), ROOT))


def wiki_vehicles(spark, sf_dir):
    return _vehicles(spark, sf_dir).select("fetch_id", "title", "status", "code", "name", "class", "nation", "tier")


def vehicle_outcomes(spark, sf_dir):
    return wiki_vehicles(spark, sf_dir).groupBy("status", "code").agg(F.count("*").alias("n"))


def unique_vehicles(spark, sf_dir):
    return wiki.unique_vehicles(_vehicles(spark, sf_dir)).select("fetch_id", "name", "kept")


def response_kinds(spark, sf_dir):
    r = read_table(spark, sf_dir, "fetch_results", "fetch_id", "status_code", "body")
    return r.select("fetch_id", fetching.response_kind(F.col("status_code"), F.col("body")).alias("kind"))


def diagnostic_counts(spark, sf_dir):
    return wiki_revisions(spark, sf_dir).where("code is not null").groupBy("code").agg(F.count("*").alias("n"))


def candidate_union(spark, sf_dir):
    a = read_table(spark, sf_dir, "strategy_segments", "tactical_concepts").select(F.explode("tactical_concepts").alias("concept"))
    b = read_table(spark, sf_dir, "guide_segments", "tactical_concepts").select(F.explode("tactical_concepts").alias("concept"))
    return a.unionAll(b).where("concept is not null").distinct()


def value_statistics(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_type", "value").where("value is not null")
    return e.groupBy("event_type").agg(
        F.min("value").alias("least"), F.expr("percentile(value, 0.5)").alias("median"), F.expr("percentile_disc(0.95) within group (order by value)").alias("p95"), F.max("value").alias("most")
    )


def backoff_schedule(spark, sf_dir):
    return spark.range(1, 9).select(F.col("id").alias("attempt"), text.backoff_seconds(F.col("id")).alias("seconds"), text.ceil_micros(F.col("id") * 1001).alias("micros"))


_Q = (
    identity_names, identity_ascii, segment_blocks, segment_sentences, tactical_statements, precedence_kept, alias_concepts, segment_concepts, concept_normalize, guide_scope, scope_join, scope_members, heading_classes,
    guide_elements, guide_page_segments, guide_rejects, access_documents, url_identity, safe_url, category_paths, category_closure, category_pages, category_evidence, category_ancestors, content_categories, direct_minus_children,
    children_and_parents, canonical_nations, canonical_classes, class_decisions, wiki_revisions, wiki_vehicles, vehicle_outcomes, unique_vehicles, response_kinds, diagnostic_counts, candidate_union, value_statistics, backoff_schedule,
)
QUERIES = {f.__name__: f for f in _Q}

_ASCII = r"lower(trim(regexp_replace({}, '[\t\n\x0b\f\r ]+', ' ', 'g')))"
_TITLE = _ASCII.format("replace({}, '_', ' ')")
_LEFT, _RIGHT = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _word(c: str, alternatives: str, ends: bool = True) -> str:
    return f"regexp_matches({c}, '(?i){_LEFT}({alternatives})" + (_RIGHT if ends else "") + "')"


def _case(c: str, table: dict) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


_LINKS = f"links AS (SELECT DISTINCT {_TITLE.format('category')} AS parent, {_TITLE.format('title')} AS child FROM category_members WHERE ns = 14 AND category IS NOT NULL AND title IS NOT NULL)"
_PATHS = f"WITH RECURSIVE {_LINKS}, walk AS (SELECT '{ROOT.lower()}' AS category, ['{ROOT.lower()}'] AS path, 0 AS depth UNION ALL SELECT l.child, list_append(w.path, l.child), w.depth + 1 FROM walk w JOIN links l ON l.parent = w.category WHERE NOT list_contains(w.path, l.child))"
_TIGHT = r"[ \t\r\n]"
_TRIM = "trim({}, ' ' || chr(9) || chr(10) || chr(13))"
_BULLET = rf"([-*+•‣▪◦]|\d{{1,3}}[.)]){_TIGHT}+"
_BLOCKS = rf"""
WITH marked AS (SELECT segment_id, regexp_replace(text, '\r?\n{_TIGHT}*\r?\n{_TIGHT}*', chr(1), 'g') AS t FROM strategy_segments WHERE text IS NOT NULL),
cut AS (SELECT segment_id, string_split(regexp_replace(t, '\r?\n{_TIGHT}*({_BULLET})', chr(1) || '\1', 'g'), chr(1)) AS l FROM marked),
one AS (SELECT segment_id, unnest(l) AS b, generate_subscripts(l, 1) AS i FROM cut),
clean AS (SELECT segment_id, i, {_TRIM.format(f"regexp_replace(b, '^{_TIGHT}*{_BULLET}', '')")} AS block FROM one),
blocks AS (SELECT segment_id, row_number() OVER (PARTITION BY segment_id ORDER BY i) - 1 AS block_no, block FROM clean WHERE block != '')
"""
# abbreviations are masked before the cut and put back after it; twice, as two in a row share a blank
def _mask(c: str) -> str:
    return rf"regexp_replace({c}, '(^|[^\p{{L}}\p{{N}}])({prose.ABBREVIATIONS})\.({_TIGHT})', '\1\2' || chr(4) || '\3', 'g')"


_SENTENCES = (
    _BLOCKS
    + rf""",
masked AS (SELECT segment_id, block_no, regexp_replace({_mask(_mask('block'))}, '([.!?]["''”»)\]]{{0,2}}){_TIGHT}+(["''“„«(]{{0,1}}\p{{Lu}})', '\1' || chr(3) || '\2', 'g') AS m FROM blocks),
lists AS (SELECT segment_id, block_no, [y FOR y IN [{_TRIM.format("replace(x, chr(4), '.')")} FOR x IN string_split(m, chr(3))] IF y != ''] AS l FROM masked),
parts AS (SELECT segment_id, block_no, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS sentence_no FROM lists),
{identity_ctes("SELECT s AS v FROM parts", "sid")},
plain AS (SELECT segment_id, block_no, sentence_no, regexp_replace(sid.canonical, '(?i)[\t-\r ]*(\[(\d+|citation needed)\]|\([\t-\r ]*source[\t-\r ]*\))[\t-\r ]*', ' ', 'g') AS s FROM parts JOIN sid ON sid.v = s),
spaced AS (SELECT segment_id, block_no, sentence_no, trim(regexp_replace(s, '[\t-\r \x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]+', ' ', 'g')) AS s FROM plain),
st AS (SELECT segment_id, block_no, sentence_no, regexp_replace(s, '^[•*\- ]+|[• ]+$', '', 'g') AS statement FROM spaced)
"""
)
_N, _ENDED = r"len(regexp_extract_all(statement, '\p{L}[\p{L}\p{M}]*'))", "regexp_matches(statement, '[.!?]$')"
_IMPERATIVE = rf"regexp_matches(statement, '(?i)^({vocab.IMPERATIVE})($|[^\p{{L}}\p{{N}}_])')"
_URL = r"regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?', ''), '[?#].*$', '')"
_RANK = "coalesce(CASE lower(trim(source_kind)) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.SOURCE_RANKS.items()) + " END, 3)"


def _aliases(c: str) -> str:
    """List of the concepts whose other names stand in a text."""
    by: dict[str, list[str]] = {}
    for alias, concept in vocab.CONCEPT_ALIASES.items():
        by.setdefault(concept, []).append(alias.replace(" ", "-").replace("-", r"[ \t\r\n-]+"))
    parts = ", ".join(f"CASE WHEN {_word(c, '|'.join(sorted(set(p), key=len, reverse=True)))} THEN '{x}' END" for x, p in sorted(by.items()))
    return f"[x FOR x IN [{parts}] IF x IS NOT NULL]"


def _one_of(words) -> str:
    return "(" + ", ".join(f"'{x}'" for x in words) + ")"


_LEMMA = r"""CASE WHEN regexp_matches({0}, '(ss|us|is)$') OR length({0}) < 4 THEN {0} WHEN regexp_matches({0}, '[^aeiou]ies$') THEN regexp_replace({0}, 'ies$', 'y')
  WHEN regexp_matches({0}, '(sh|ch|x|z|ss)es$') THEN regexp_replace({0}, 'es$', '') ELSE regexp_replace({0}, 's$', '') END"""
_CONCEPTS = _SENTENCES + rf""", w AS (SELECT segment_id, block_no, sentence_no, statement, [{_LEMMA.format("lower(x)")} FOR x IN regexp_extract_all(statement, '\p{{L}}[\p{{L}}\p{{M}}]*')] AS l FROM st WHERE statement != ''),
  n AS (SELECT segment_id, block_no, sentence_no, list_concat([coalesce({_case('x', vocab.CONCEPT_ALIASES)}, x) FOR x IN l IF x IN {_one_of(vocab.TACTICAL_NOUNS)}], {_aliases('statement')}) AS c FROM w)
  SELECT segment_id, block_no, sentence_no, list_sort(list_distinct([x FOR x IN c IF length(x) <= 120 AND x NOT IN {_one_of(vocab.GENERIC_TERMS)}])) AS concepts FROM n"""
_PAGES = f"""members AS (SELECT {_TITLE.format('title')} AS key, page_id, {_TITLE.format('category')} AS category FROM category_members WHERE ns IS DISTINCT FROM 14 AND title IS NOT NULL),
  known AS (SELECT key, min(page_id) AS known FROM members GROUP BY key),
  merged AS (SELECT key, coalesce(page_id, known) AS page_id, category FROM members JOIN known USING (key)),
  pages AS (SELECT min(key) AS title, page_id, list_sort(list(DISTINCT category) FILTER (WHERE category IS NOT NULL)) AS categories FROM merged GROUP BY page_id, CASE WHEN page_id IS NULL THEN key END)"""
_EVIDENCE = _PATHS + f""", above AS (SELECT DISTINCT category, unnest(path) AS above FROM walk), {_PAGES},
      own AS (SELECT title, page_id, unnest(categories) AS category FROM pages),
      every AS (SELECT title, page_id, category FROM own UNION SELECT title, page_id, above FROM own JOIN above USING (category)),
      leaf AS (SELECT title, page_id, regexp_replace(category, '^category:', '') AS l FROM every),
      told AS (SELECT title, page_id, {_case('l', vocab.CLASS_ALIASES)} AS class, {_case('l', vocab.SUBCLASS_ALIASES)} AS subclass, coalesce({_case('l', vocab.NATION_ALIASES)}, {_case("regexp_replace(l, ' tanks?$', '')", vocab.NATION_ALIASES)}) AS nation,
        regexp_extract(l, '^tier ([ivxlcdm]+|\\d{{1,3}})(?: tanks?)?$', 1) AS token FROM leaf),
      tiers AS (SELECT title, page_id, class, subclass, nation, CASE WHEN t BETWEEN 1 AND 10 THEN t END AS tier FROM (SELECT *, coalesce(try_cast({_case('token', vocab.ROMAN_TIERS)} AS INT), try_cast(token AS INT)) AS t FROM told))"""


_CLASS_CASES = ", ".join(f"CASE WHEN {_word('text', p)} THEN '{n}' END" for n, p in vocab.HEADING_CLASSES.items())
_LATEST = "SELECT name, class FROM (SELECT name, class, row_number() OVER (PARTITION BY name ORDER BY extracted_at DESC NULLS LAST, loaded_at DESC NULLS LAST, row_id DESC) AS rn FROM tanks_data WHERE name IS NOT NULL) WHERE rn = 1"
_REVISIONS = r"""WITH j AS (SELECT fetch_id, body::JSON AS b FROM fetch_results WHERE regexp_matches(body, '^[ \t\r\n]*\{') AND json_valid(body)),
      p AS (SELECT fetch_id, unnest(CASE json_type(b, '$.query.pages') WHEN 'ARRAY' THEN json_extract(b, '$.query.pages[*]') WHEN 'OBJECT' THEN json_extract(b, '$.query.pages.*') END) AS p FROM j WHERE json_extract(b, '$.query.pages') IS NOT NULL),
      x AS (SELECT *, coalesce(p->>'$.revisions[0].slots.main.content', p->>'$.revisions[0].content') AS text FROM p),
      rev AS (SELECT fetch_id, (p->>'$.pageid')::BIGINT AS page_id, p->>'$.title' AS title, text, CASE WHEN p->>'$.missing' IS NOT NULL THEN 'missing_page' WHEN text IS NULL THEN 'missing_revision' END AS code FROM x
      UNION ALL SELECT fetch_id, NULL, NULL, NULL, 'api_error' FROM j WHERE json_extract(b, '$.error') IS NOT NULL)
"""
# boxes of one line with plain values, as the recorded pages have them
_VEHICLES = (
    _EVIDENCE.replace("WITH RECURSIVE", "WITH RECURSIVE " + _REVISIONS.strip().removeprefix("WITH ") + ",")
    + rf""", per AS (SELECT title AS page, list(DISTINCT class) FILTER (WHERE class IS NOT NULL) AS classes FROM tiers GROUP BY title),
  direct AS (SELECT title AS page, list(DISTINCT coalesce({_case('dl', vocab.NATION_ALIASES)}, {_case("regexp_replace(dl, ' tanks?$', '')", vocab.NATION_ALIASES)})) AS nations,
    list(DISTINCT {_case("regexp_extract(dl, '^tier ([ivx]+)(?: tanks?)?$', 1)", vocab.ROMAN_TIERS)}) AS tiers_ FROM (SELECT title, regexp_replace(category, '^category:', '') AS dl FROM own) GROUP BY title),
  box AS (SELECT *, regexp_extract_all(text, '(?i)\{{\{{infobox vehicle[^{{}}]*\}}\}}') AS boxes, lower(replace(title, '_', ' ')) AS page FROM rev),
  field AS (SELECT *, {", ".join(f"nullif(trim(regexp_extract(boxes[1], '(?i)[|] *{n} *= *([^|}}]*)', 1)), '') AS {n}_text" for n in ("tier", "nation", "class"))}, replace(regexp_extract(title, '^[Tt]ank:(.+)$', 1), ' ', '_') AS name FROM box),
  met AS (SELECT f.*, coalesce(classes, []) AS classes, [x FOR x IN coalesce(nations, []) IF x IS NOT NULL] AS nations, [try_cast(x AS INT) FOR x IN coalesce(tiers_, []) IF x IS NOT NULL] AS tiers_, {_case("lower(class_text)", vocab.CLASS_ALIASES)} AS box_class, {_case("lower(nation_text)", vocab.NATION_ALIASES)} AS box_nation
    FROM field f LEFT JOIN per USING (page) LEFT JOIN direct USING (page)),
  decided AS (SELECT *, CASE WHEN code IS NOT NULL THEN code WHEN len(boxes) = 0 THEN 'non_vehicle_candidate' WHEN len(boxes) > 1 THEN 'competing_vehicle_infoboxes'
    WHEN name = '' THEN 'missing_vehicle_identifier' WHEN NOT regexp_full_match(name, '[A-Za-z0-9][A-Za-z0-9_.-]*') THEN 'invalid_vehicle_identifier'
    WHEN len(classes) > 1 THEN 'contradictory_taxonomy_classes' WHEN class_text IS NOT NULL AND box_class IS NULL THEN 'unknown_infobox_class' WHEN len(classes) = 1 AND box_class != classes[1] THEN 'primary_class_conflict'
    WHEN len(classes) = 0 AND box_class IS NULL THEN 'missing_primary_class'
    WHEN nation_text IS NULL AND len(nations) > 1 THEN 'contradictory_taxonomy_nations' WHEN nation_text IS NULL AND len(nations) = 0 THEN 'missing_nation' WHEN nation_text IS NOT NULL AND box_nation IS NULL THEN 'unknown_nation'
    WHEN tier_text IS NULL AND len(tiers_) > 1 THEN 'contradictory_taxonomy_tiers' WHEN tier_text IS NULL AND len(tiers_) = 0 THEN 'missing_tier' WHEN tier_text IS NOT NULL AND NOT coalesce(try_cast(tier_text AS INT) BETWEEN 1 AND 10, false) THEN 'invalid_tier' END AS outcome_code FROM met),
  outcome AS (SELECT fetch_id, title, CASE WHEN outcome_code IS NULL THEN 'accepted' WHEN outcome_code = 'non_vehicle_candidate' THEN 'non_vehicle' ELSE 'rejected' END AS status, outcome_code AS code, name,
    coalesce(box_class, classes[1]) AS class, coalesce(box_nation, nations[1]) AS nation, coalesce(try_cast(tier_text AS INT), tiers_[1]) AS tier FROM decided)
"""
)
ORACLES = {
    "identity_ascii": f"SELECT DISTINCT title, {_ASCII.format('title')} AS identity FROM category_members",
    "segment_blocks": _BLOCKS + "SELECT segment_id, block_no, block FROM blocks",
    "segment_sentences": _SENTENCES + "SELECT segment_id, block_no, sentence_no, statement FROM st WHERE statement != ''",
    "tactical_statements": _SENTENCES
    + f"""SELECT segment_id, block_no, sentence_no FROM st WHERE statement != '' AND {_N} >= 2 AND length(statement) <= 1000 AND NOT {_word('statement', vocab.NON_TACTICAL)}
      AND ({_word('statement', vocab.TACTICAL, ends=False)} OR {_IMPERATIVE} OR ({_N} >= 5 AND {_ENDED})) AND NOT ({_N} <= 4 AND NOT {_ENDED} AND NOT {_IMPERATIVE})""",
    "concept_normalize": f"""WITH w AS (SELECT DISTINCT unnest(keywords) AS keyword FROM tanks_data), k AS (
      SELECT keyword, trim(array_to_string([p FOR p IN string_split(regexp_replace(lower(keyword), '[^\\p{{L}}\\p{{N}}\\p{{M}}_-]+', ' ', 'g'), ' ') IF p != '' AND p NOT IN ({', '.join(f"'{x}'" for x in vocab.STOP_WORDS)})], ' '), ' -_') AS c FROM w WHERE keyword IS NOT NULL),
      c AS (SELECT keyword, coalesce({_case('c', vocab.CONCEPT_ALIASES)}, c) AS concept FROM k)
      SELECT keyword, concept, concept != '' AND length(concept) <= 120 AND concept NOT IN ({', '.join(f"'{x}'" for x in vocab.GENERIC_TERMS)}) AND NOT regexp_matches(concept, '^[0-9 \\t\\r\\n.,:+/-]+$') AS valid FROM c""",
    "segment_concepts": _CONCEPTS,
    "identity_names": "WITH " + identity_ctes("SELECT display_name AS v FROM tanks_data") + "SELECT row_id, canonical, identity FROM tanks_data LEFT JOIN ids ON v = display_name",
    "url_identity": rf"""WITH u AS (SELECT fetch_id, trim(url) AS url FROM fetch_results),
      p AS (SELECT fetch_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
        [x FOR x IN string_split(regexp_extract(url, '\?([^#]*)', 1), '&') IF x != '' AND lower(regexp_extract(x, '^[^=]*')) NOT IN {_one_of(vocab.TRACKING_KEYS)} AND NOT starts_with(lower(x), 'utm_')] AS items FROM u)
      SELECT fetch_id, CASE WHEN scheme IN ('http', 'https') AND host != '' THEN scheme || '://' || regexp_replace(host, CASE scheme WHEN 'http' THEN ':80$' ELSE ':443$' END, '') ||
        '/' || ltrim(regexp_replace(path, '/+', '/', 'g'), '/') || CASE WHEN len(items) > 0 THEN '?' || array_to_string(list_sort(items), '&') ELSE '' END END AS url FROM p""",
    "wiki_vehicles": _VEHICLES + "SELECT fetch_id, title, status, code, CASE WHEN code IS NULL THEN name END AS name, CASE WHEN code IS NULL THEN class END AS class, CASE WHEN code IS NULL THEN nation END AS nation, CASE WHEN code IS NULL THEN tier END AS tier FROM outcome",
    "vehicle_outcomes": _VEHICLES + "SELECT status, code, count(*) AS n FROM outcome GROUP BY status, code",
    "unique_vehicles": _VEHICLES + "SELECT fetch_id, name, row_number() OVER (PARTITION BY lower(name) ORDER BY name, lower(title), title, fetch_id) = 1 AS kept FROM outcome WHERE code IS NULL",
    "wiki_revisions": _REVISIONS + "SELECT * FROM rev",
    "diagnostic_counts": _REVISIONS + "SELECT code, count(*) AS n FROM rev WHERE code IS NOT NULL GROUP BY code",
    "category_evidence": _EVIDENCE
    + """ SELECT title, page_id, coalesce(string_agg(DISTINCT class, '|' ORDER BY class), '') AS classes, coalesce(string_agg(DISTINCT subclass, '|' ORDER BY subclass), '') AS subclasses, coalesce(string_agg(DISTINCT nation, '|' ORDER BY nation), '') AS nations,
        coalesce(array_to_string(list_sort(list(DISTINCT tier) FILTER (WHERE tier IS NOT NULL)), '|'), '') AS tiers FROM tiers GROUP BY title, page_id""",
    "category_ancestors": _PATHS + "SELECT DISTINCT category, unnest(path) AS above FROM walk",
    "class_decisions": _EVIDENCE
    + f""", cs AS (SELECT regexp_replace(title, '^tank:', '') AS key, list_sort(list(DISTINCT class) FILTER (WHERE class IS NOT NULL)) AS classes FROM tiers GROUP BY 1),
      r AS ({_LATEST}), {identity_ctes("SELECT replace(name, '_', ' ') AS v FROM r", "nid")}, {identity_ctes("SELECT replace(class, '_', ' ') AS v FROM r WHERE class IS NOT NULL", "cid")},
      d AS (SELECT name, nullif(trim(class), '') AS given, {_case("regexp_replace(cid.identity, '^category:', '')", vocab.CLASS_ALIASES)} AS own, coalesce(classes, []) AS classes
        FROM r JOIN nid ON nid.v = replace(name, '_', ' ') LEFT JOIN cid ON cid.v = replace(class, '_', ' ') LEFT JOIN cs ON key = nid.identity),
      c AS (SELECT *, CASE WHEN len(classes) > 1 THEN 'contradictory_taxonomy_classes' WHEN given IS NOT NULL AND own IS NULL THEN 'unknown_infobox_class'
        WHEN len(classes) = 1 AND own != classes[1] THEN 'primary_class_conflict' WHEN len(classes) = 0 AND own IS NULL THEN 'missing_primary_class' END AS code FROM d)
      SELECT name, CASE WHEN code IS NULL THEN coalesce(own, classes[1]) END AS class, code, CASE WHEN code IS NULL AND len(classes) = 0 THEN 'missing_taxonomy_class_evidence' WHEN code IS NULL AND own IS NULL THEN 'infobox_class_fallback' END AS warning FROM c""",
    "precedence_kept": "WITH " + identity_ctes("SELECT text AS v FROM strategy_segments", "t1")
    + rf""", n AS (SELECT v, regexp_replace(trim(regexp_replace(regexp_replace(canonical, '(?i)[\t-\r ]*(\[(\d+|citation needed)\]|\([\t-\r ]*source[\t-\r ]*\))[\t-\r ]*', ' ', 'g'), ' +', ' ', 'g')), '^[•*\- ]+|[• ]+$', '', 'g') AS s FROM t1), {identity_ctes("SELECT s AS v FROM n", "t2")}
      SELECT identity, segment_id, rank FROM (SELECT identity, segment_id, {_RANK} AS rank, row_number() OVER (PARTITION BY identity ORDER BY {_RANK}, segment_id) AS rn FROM strategy_segments JOIN n ON n.v = text JOIN t2 ON t2.v = n.s) WHERE rn = 1""",
    "alias_concepts": f"SELECT * FROM (SELECT text, array_to_string({_aliases('text')}, '|') AS concepts FROM (SELECT text FROM strategy_segments UNION SELECT unnest(keywords) FROM tanks_data) WHERE text IS NOT NULL) WHERE concepts != ''",
    "response_kinds": """WITH b AS (SELECT fetch_id, status_code, body, lower(body) AS l FROM fetch_results),
      k AS (SELECT *, regexp_matches(l, 'captcha|checking your browser|verify you are human|please enable javascript and cookies|just a moment') AS checks, regexp_matches(l, '<main|<article|mw-parser-output') AS article,
        regexp_matches(body, '^[ \\t\\r\\n]*[{\\[]') AND (contains(l, '"query"') OR contains(l, '"error"')) AS api FROM b)
      SELECT fetch_id, CASE WHEN body IS NULL OR trim(body) = '' THEN 'empty' WHEN checks AND NOT article THEN 'blocked' WHEN api THEN 'api' WHEN article THEN 'article' WHEN status_code >= 400 THEN 'error' ELSE 'other' END AS kind FROM k""",
    "guide_scope": "SELECT class, count(*) AS guides FROM (SELECT guide_id, unnest(list_distinct(applicable_classes)) AS class FROM guide_segments) WHERE class IS NOT NULL GROUP BY class",
    "scope_join": f"WITH r AS ({_LATEST}), g AS (SELECT DISTINCT guide_id, unnest(applicable_classes) AS class FROM guide_segments) SELECT name, class, count(*) AS guides FROM r JOIN g USING (class) GROUP BY name, class",
    "scope_members": "SELECT DISTINCT class, guide_id FROM (SELECT guide_id, unnest(applicable_classes) AS class FROM guide_segments) WHERE class IS NOT NULL",
    "heading_classes": f"SELECT guide_id, array_to_string(list_sort([x FOR x IN [{_CLASS_CASES}] IF x IS NOT NULL]), '|') AS classes FROM guide_segments WHERE text IS NOT NULL",
    "access_documents": f"SELECT fetch_id FROM fetch_results WHERE {_word('body', vocab.ACCESS_DOCUMENT)}",
    "safe_url": f"SELECT fetch_id, {_URL} AS safe FROM fetch_results",
    "category_paths": _PATHS + "SELECT category, array_to_string(path, ' > ') AS path, depth FROM walk",
    "category_closure": _PATHS + "SELECT category, min(depth) AS depth FROM walk GROUP BY category",
    "category_pages": f"WITH {_PAGES} SELECT title, page_id, array_to_string(categories, '|') AS categories FROM pages",
    "content_categories": f"SELECT DISTINCT leaf FROM (SELECT regexp_replace({_TITLE.format('category')}, '^category:', '') AS leaf FROM category_members WHERE category IS NOT NULL) WHERE leaf NOT IN {_one_of(vocab.ORGANIZATIONAL)}",
    "direct_minus_children": f"WITH {_LINKS} SELECT DISTINCT parent AS category FROM (SELECT parent FROM links EXCEPT ALL SELECT child FROM links)",
    "children_and_parents": f"WITH {_LINKS} SELECT parent AS category FROM links INTERSECT SELECT child FROM links",
    "canonical_nations": "WITH " + identity_ctes("SELECT nation AS v FROM tanks_data UNION SELECT alias FROM nation_aliases")
    + """, a AS (SELECT identity, min(canonical) AS canonical FROM (SELECT na.canonical, i.identity FROM nation_aliases na JOIN ids i ON i.v = na.alias) GROUP BY identity)
      SELECT row_id, coalesce(a.canonical, nation) AS nation FROM tanks_data LEFT JOIN ids ON v = nation LEFT JOIN a ON a.identity = ids.identity""",
    "canonical_classes": "WITH " + identity_ctes("SELECT replace(class, '_', ' ') AS v FROM tanks_data") + f"SELECT row_id, {_case("regexp_replace(identity, '^category:', '')", vocab.CLASS_ALIASES)} AS class FROM tanks_data LEFT JOIN ids ON v = replace(class, '_', ' ')",
    "candidate_union": "SELECT DISTINCT concept FROM (SELECT unnest(tactical_concepts) AS concept FROM strategy_segments UNION ALL SELECT unnest(tactical_concepts) FROM guide_segments) WHERE concept IS NOT NULL",
    "value_statistics": "SELECT event_type, min(value) AS least, quantile_cont(value, 0.5) AS median, quantile_disc(value, 0.95) AS p95, max(value) AS most FROM events WHERE value IS NOT NULL GROUP BY event_type",
    "backoff_schedule": "SELECT i AS attempt, least(15.0, greatest(5.0, pow(2, i - 1)))::DOUBLE AS seconds, ceil(i * 1001 / 1000.0)::BIGINT AS micros FROM range(1, 9) t(i)",
}
