"""Main content of pages by composite text density.

Every element gets its characters for each tag, adjusted by how many of them, and of the tags, are links; the
element whose children's densities sum highest holds the article, and a part beside the way from it to the body belongs to it if it is as dense
as the way is at its thinnest. What density says of a form of line over all pages (``lines``) then tells the lines that it can't place on one page:
lines inside the article that it finds outside elsewhere go, short parts beside the article that it finds inside elsewhere stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.markup import Block, Node, parse, path
from ..sources import spread
from .lines import Learned, Lines, form_shares, ids_of, tidy
from .residue import is_html, residue_ids, texts, without, without_copies


def density(n: Node, body: Node) -> float:
    """Composite text density of an element."""
    c, t = n.chars, max(n.tags, 1)
    if not c:
        return 0.0
    lc, lt = max(n.link_chars, 1), max(n.link_tags, 1)
    free = max(c - n.link_chars, 1)
    base = log(c / free * lc + body.link_chars / max(body.chars, 1) * c + e)
    return c / t * log(max(c / lc * t / lt, 1 + 1e-9)) / log(max(base, 1 + 1e-9)) if free > 1 else 0.0


def placed(body: str) -> list[tuple[Block, bool]]:
    """Blocks of a page in order, and whether density puts them into the article. A block that is mostly links isn't in it."""
    root, blocks = parse(body)
    if not blocks:
        return []
    nodes = {id(n): n for b in blocks for n in path(b.node)}
    top = next((n for n in path(blocks[0].node) if n.tag == "body"), root)
    dense = {k: density(n, top) for k, n in nodes.items()}
    total = {k: sum(dense.get(id(x), 0.0) for x in n.kids) or dense[k] for k, n in nodes.items()}
    best = max(nodes.values(), key=lambda n: (total[id(n)], -n.order))
    way = path(best)
    threshold = min((dense[id(n)] for n in way if n is not root), default=0.0)
    on_way = {id(n) for n in way}

    def inside(b: Block) -> bool:
        below = None
        for n in path(b.node):
            if n is best:
                return True
            if id(n) in on_way:
                break
            below = n
        return below is not None and dense[id(below)] >= threshold  # a part beside the way, as dense as the way at its thinnest

    return [(b, b.link_chars < 0.5 * max(b.chars, 1) and inside(b)) for b in blocks]


def main_blocks(body: str, lines: Lines, inner: float = 0.1) -> list[Block]:
    """Blocks of the article, in order. A body without text has none.

    ``inner`` is the share outside up to which a known form of line counts as one of articles.
    """
    out, blocks = [], placed(body)
    for (b, inside), share in zip(blocks, lines.all_outside([tidy(b.text) for b, _ in blocks]), strict=True):
        if share < lines.most if inside else 0 < share < inner and b.link_chars < 0.5 * max(b.chars, 1):
            out.append(b)
    return out


def lines_of(text: str) -> list[str]:
    return [x for x in re.split(r"\r\n|\n|\r", text) if x.strip()]


def guide_lines(text: str, lines: Lines) -> list[tuple[int, str]]:
    """(number, line) of the article's lines among the lines that aren't blank."""
    found = lines_of(text)
    return [(i, x) for i, (x, around) in enumerate(zip(found, lines.all_furniture([tidy(x) for x in found]), strict=True)) if not around]


def line_forms(fetched: DataFrame) -> Learned:
    """What density says of each form of line on all HTML pages of ``fetched`` (fetch_id, body), each different body once: one map pass, forms summed in the tasks before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: dict[int, list[int]] = {}
            for body in b["body"]:
                if body and is_html(body):
                    for block, inside in placed(body):
                        for f in ids_of([tidy(block.text)]):
                            n = counts.setdefault(f, [0, 0])
                            n[0] += 1
                            n[1] += not inside
            yield pd.DataFrame([(f, *n) for f, n in counts.items()], columns=["form", "lines", "outside"])

    return Learned(form_shares(without_copies(fetched.select("fetch_id", "body")).select("body").where("body is not null").mapInPandas(run, "form bigint, lines bigint, outside bigint")))


def main_content(guides: DataFrame, fetched: DataFrame) -> DataFrame:
    """(src, record_id, block_no, text) of the main content of guide texts and fetched HTML bodies.

    Guide texts have no tags: their lines are judged by what density says of such lines on the pages. Records without content (null, empty or blank texts, JSON bodies,
    template residue and error pages) give no rows. Repeated rows have their own ids. Three map passes over the bodies and one over the guides.
    """
    pages = spread(fetched.select("fetch_id", "body", *{"url"} & {*fetched.columns}))
    learned = line_forms(pages)
    judge = learned.judge()
    kept = without(pages, residue_ids(pages, learned).distinct())

    def of_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, body, ids, shares in b.itertuples(index=False, name=None):
                if body and is_html(body):
                    rows += [("fetch", k, x.no, x.text) for x in main_blocks(body, judge(ids, shares))]
            yield pd.DataFrame(rows, columns=["src", "record_id", "block_no", "text"])

    def of_guides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [("guide", k, i, x.strip()) for k, t, ids, shares in b.itertuples(index=False, name=None) if t for i, x in guide_lines(t, judge(ids, shares))]
            yield pd.DataFrame(rows, columns=["src", "record_id", "block_no", "text"])

    schema = "src string, record_id bigint, block_no bigint, text string"
    known = ("known_forms", "known_shares")
    of_guide = learned.beside(spread(guides.select("guide_id", "text")), "guide_id", "text", lambda t: [tidy(x) for x in lines_of(t)]).select("guide_id", "text", *known)
    of_page = learned.beside(kept.select("fetch_id", "body"), "fetch_id", "body", texts).select("fetch_id", "body", *known)
    return of_guide.mapInPandas(of_guides, schema).unionAll(of_page.mapInPandas(of_pages, schema))
