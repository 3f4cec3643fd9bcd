"""Strict admission of one JSON array of records, on the driver, before any Spark job."""

from __future__ import annotations

import json
import stat
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import json_path, truncate_message
from ..operators.records import Limits, violation_report, violations

_TEXT = ArrayType(StringType(), True)
SCHEMA = StructType(
    [StructField("ordinal", LongType(), False)]
    + [StructField(f, _TEXT if f in ("subclasses", "strategies", "keywords") else IntegerType() if f == "tier" else StringType()) for f in ("name", "display_name", "class", "subclasses", "nation", "tier", "strategies", "keywords")]
)
FIELDS = [f.name for f in SCHEMA.fields[1:]]


class IngestError(Exception):
    """A file that isn't admitted; ``code`` is one of path_not_found, open_failed, not_regular_file, file_too_large, json_syntax, semantic_validation."""

    exit_code = 3

    def __init__(self, code: str, message: str, **context):
        super().__init__(message if len(message) <= 200 else message[:200] + "…")
        self.code, self.context = code, context


@dataclass(frozen=True)
class Dataset:
    records: DataFrame
    warnings: tuple[str, ...] = ()

    @property
    def is_production_success(self) -> bool:
        return not self.warnings


def read_bounded(path: str, most: int) -> bytes:
    """The file's bytes; never more than ``most`` + 1 are read, so a growing file can't pass."""
    p = Path(path)
    try:
        info = p.stat()
    except FileNotFoundError:
        raise IngestError("path_not_found", f"{path} doesn't exist") from None
    except OSError as e:
        raise IngestError("open_failed", f"{path}: {e.strerror}") from None
    if not stat.S_ISREG(info.st_mode):
        raise IngestError("not_regular_file", f"{path} is no regular file")
    if info.st_size > most:
        raise IngestError("file_too_large", f"{path} has {info.st_size} bytes, {most} are allowed")
    try:
        with p.open("rb") as f:
            data = f.read(most + 1)
    except OSError as e:
        raise IngestError("open_failed", f"{path}: {e.strerror}") from None
    if len(data) > most:
        raise IngestError("file_too_large", f"{path} has more than {most} bytes")
    return data


def _pairs(pairs):
    out = {}
    for k, v in pairs:
        if k in out:
            raise ValueError(f"duplicate field {k!r}")
        out[k] = v
    return out


def _constant(name):
    raise ValueError(f"{name} is no JSON number")


def _record(n: int, row) -> tuple:
    def bad(what: str):
        return IngestError("json_syntax", f"$[{n}]{what}")

    if not isinstance(row, dict):
        raise bad(" is no object")
    for k in row:
        if k not in FIELDS:
            raise bad(f": unknown field {k!r}")
    for f in FIELDS:
        if f not in row:
            raise bad(f": missing field {f!r}")
        v = row[f]
        if f == "tier":
            if type(v) is not int or not 0 <= v <= 255:
                raise bad(".tier is no integer of 0 to 255")
        elif f in ("subclasses", "strategies", "keywords"):
            if not isinstance(v, list) or any(not isinstance(x, str) for x in v):
                raise bad(f".{f} is no list of texts")
        elif not isinstance(v, str):
            raise bad(f".{f} is no text")
    return (n, *(row[f] for f in FIELDS))


def decode(data: bytes) -> list[tuple]:
    """Rows of exactly one array of closed objects: no byte order mark, no second document, no duplicate, unknown, missing or null field, no other type."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as e:
        raise IngestError("json_syntax", f"not UTF-8 at byte {e.start}") from None
    if text.startswith("﻿"):
        raise IngestError("json_syntax", "byte order mark")
    try:
        rows = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant)
    except (ValueError, RecursionError) as e:
        raise IngestError("json_syntax", str(e)) from None
    if not isinstance(rows, list):
        raise IngestError("json_syntax", "the root is no array")
    return [_record(n, r) for n, r in enumerate(rows)]


def load_dataset(spark: SparkSession, path: str, limits: Limits = Limits(), most_bytes: int = 256 << 20) -> Dataset:
    """Records with their ordinal, or an IngestError that names the first violations and counts all."""
    rows = decode(read_bounded(path, most_bytes))
    if len(rows) > limits.records:
        raise IngestError("semantic_validation", f"{len(rows)} records, {limits.records} are allowed", total=1)
    df = spark.createDataFrame(rows, SCHEMA)
    found = violations(df, "ordinal", limits)
    total = found.count()
    from ..operators.assemble import duplicate_identities
    from ..operators.records import order_breaks

    twice = [list(r.spellings) for r in duplicate_identities(df, "name").limit(limits.shown).collect()]
    unsorted = order_breaks(df, "name", "ordinal", 4).limit(1).collect() if len(rows) > 1 and not twice else []
    if total or twice or unsorted:
        line = truncate_message(F.concat_ws(" ", json_path(F.col("ordinal"), F.col("field"), F.col("item")), F.col("message")))
        shown = [r.line for r in violation_report(found, "ordinal", limits.shown).select(line.alias("line")).collect()]
        shown += [f"names {x} are the same" for x in twice] + [f"$[{r.ordinal}].name is not sorted" for r in unsorted]
        raise IngestError("semantic_validation", "; ".join(shown), total=total + len(twice) + len(unsorted), shown=shown[: limits.shown])
    return Dataset(df, () if rows else ("the dataset is empty",))
