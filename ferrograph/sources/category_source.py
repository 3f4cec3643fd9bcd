"""Spark data source over recorded category payloads: one JSON file of pages a category."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "category string, ns int, page_id bigint, title string, seq int"


def members(category: str, pages: list[dict]):
    """Rows of a category's response pages in order; an API error, a malformed page or a repeated continuation is a ValueError."""
    seq, tokens = 0, set()
    for page in pages:
        if error := page.get("error"):
            raise ValueError(f"{category}: {error.get('info')}")
        listed = page.get("query", {}).get("categorymembers")
        if not isinstance(listed, list):
            raise ValueError(f"{category}: no members in the response")
        for m in listed:
            yield category, m.get("ns"), m.get("pageid"), m.get("title"), seq
            seq += 1
        token = page.get("continue", {}).get("cmcontinue")
        if token is not None and token in tokens:
            raise ValueError(f"{category}: continuation {token!r} repeats")
        tokens.add(token)


class CategoryReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(str(p)) for p in sorted(Path(self.path).glob("*.json"))]

    def read(self, partition):
        for category, pages in json.loads(Path(partition.value).read_text("utf-8")).items():
            yield from members(category, pages)


class CategorySource(DataSource):
    """``spark.dataSource.register(CategorySource)``, then ``spark.read.format("category_payloads").load(folder)``."""

    @classmethod
    def name(cls):
        return "category_payloads"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return CategoryReader(self.options["path"])
