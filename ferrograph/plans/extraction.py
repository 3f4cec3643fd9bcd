"""The whole extraction over recorded inputs: taxonomy, pages and guides to one published record file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assemble, guides, taxonomy, wiki
from ..operators.records import Limits
from ..sources.config import Config, nation_filter
from ..sources.publish import write_dataset


class ExtractionError(Exception):
    """Nothing was published; ``codes`` counts why candidates were rejected."""

    exit_code = 1

    def __init__(self, message: str, codes: dict[str, int]):
        super().__init__(message)
        self.codes = codes


@dataclass(frozen=True)
class RunSummary:
    category_count: int
    candidate_page_count: int
    accepted_tank_count: int
    rejected_candidate_count: int
    guide_page_count: int
    skipped_guide_count: int
    strategy_count: int
    keyword_count: int
    retry_count: int
    output_path: str


def guide_segments_of(pages: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(segments, outcome): tactical segments of the guide pages (fetch_id, url, body) that pass all gates; ``outcome`` is (fetch_id, code) of all pages, null if used."""
    root = guides.clean_address(F.lit(config.guide_root))
    addressed = pages.where("body is not null").withColumn("url", guides.clean_address(F.col("url")))
    inside = addressed.where(F.coalesce(F.startswith("url", root), F.lit(False)))
    outside = pages.join(inside.select("fetch_id"), "fetch_id", "left_anti").select("fetch_id", F.lit("outside_boundary").alias("code"))
    elements = guides.guide_elements(inside).persist(StorageLevel.MEMORY_AND_DISK)
    gates = guides.page_gates(elements)
    used = inside.select("fetch_id", "url").join(gates, "fetch_id", "left")
    segments = guides.guide_segments(elements).join(used.where("code is null").select("fetch_id", "url"), "fetch_id")
    return segments, used.select("fetch_id", "code").unionByName(outside)


def run_extraction(config: Config, members: DataFrame, payloads: DataFrame, pages: DataFrame, to: str, limits: Limits = Limits(), retries: int = 0) -> RunSummary:
    """Publishes the records of all accepted vehicles, or raises and leaves an earlier file in place.

    ``members`` is (category, ns, page_id, title), ``payloads`` and ``pages`` are (fetch_id, url, body). Rejected candidates are counted; they stop the run only if none is
    accepted. Of vehicles of one name the first is kept, the others count as rejected.
    """
    evidence = taxonomy.evidence(members, config.root_category).persist(StorageLevel.MEMORY_AND_DISK)
    found = wiki.vehicles(wiki.revisions(payloads), evidence).persist(StorageLevel.MEMORY_AND_DISK)
    unique = wiki.unique_vehicles(found).persist(StorageLevel.MEMORY_AND_DISK)
    wanted = unique.where("kept").where(nation_filter(F.col("nation"), config.nations))
    codes = {r.code: r.n for r in found.where("status = 'rejected'").groupBy("code").agg(F.count("*").alias("n")).collect()}
    if dropped := unique.where("not kept").count():
        codes["duplicate_tank_identity"] = dropped
    accepted = wanted.count()
    if not accepted:
        raise ExtractionError(f"no vehicle was accepted, {sum(codes.values())} candidates were rejected; nothing was published", codes)
    segments, outcome = guide_segments_of(pages, config)
    sources = assemble.wiki_sources(wanted).unionByName(assemble.guide_sources(segments), allowMissingColumns=True)
    records = assemble.assemble(wanted.select("name", "display_name", "class", "subclasses", "nation", "tier"), sources).persist(StorageLevel.MEMORY_AND_DISK)
    write_dataset(records, to, limits=limits, producer=True)
    size = records.agg(F.sum(F.size("strategies")).alias("s"), F.sum(F.size("keywords")).alias("k")).head()
    seen = outcome.agg(F.count_if(F.col("code").isNull()).alias("used"), F.count_if(F.col("code").isNotNull()).alias("skipped")).head()
    return RunSummary(
        taxonomy.closure(members, config.root_category).count(), evidence.count(), accepted, sum(codes.values()), seen.used, seen.skipped, size.s or 0, size.k or 0, retries, to,
    )
