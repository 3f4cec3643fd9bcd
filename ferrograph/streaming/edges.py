"""Edges of records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import edges_of_row
from ..operators.records import LISTS, clean_list


def streamed_edges(snapshots: DataFrame, late: str = "7 days") -> DataFrame:
    """(loaded_at, edge columns): distinct edges of a stream of snapshots; an edge comes again only if it arrives later than ``late`` after it was seen.

    The state is one key for each edge of the last ``late``; the watermark on ``loaded_at`` drops older ones. Snapshots without name give none.
    """
    clean = snapshots.where("name is not null").withColumns({c: clean_list(F.col(c)) for c in LISTS}).withWatermark("loaded_at", late)
    edges = clean.select("loaded_at", F.inline(edges_of_row()))
    return edges.dropDuplicatesWithinWatermark(["src_kind", "src", "etype", "dst_kind", "dst"])
