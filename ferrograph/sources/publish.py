"""Atomic publication of a bounded record set as one JSON array."""

from __future__ import annotations

import contextlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame

from ..functions.text import identity_text
from ..operators.records import Limits, violations
from .admit import FIELDS, IngestError


def serialize(rows: list[dict]) -> bytes:
    """Byte-stable UTF-8: two spaces, no NaN, a final newline."""
    return (json.dumps(rows, ensure_ascii=False, indent=2, allow_nan=False) + "\n").encode()


def write_dataset(records: DataFrame, to: str, nonempty: bool = True, limits: Limits = Limits(), producer: bool = False) -> int:
    """Validates, sorts by (identity, name), writes beside the target and replaces it at once; an earlier file stays if anything fails. Returns the bytes.

    Only a published set of at most ``limits.records`` rows may come to the driver; a larger one is refused before it is fetched.
    """
    n = records.limit(limits.records + 1).count()
    if n > limits.records:
        raise IngestError("semantic_validation", f"more than {limits.records} records")
    if nonempty and not n:
        raise IngestError("semantic_validation", "nothing to publish")
    if bad := violations(records, "name", limits, producer).limit(1).collect():
        raise IngestError("semantic_validation", f"{bad[0].name}: {bad[0].field} {bad[0].message}")
    rows = [{f: (list(r[f]) if isinstance(r[f], list) else r[f]) for f in FIELDS} for r in records.select(*FIELDS).toLocalIterator()]
    rows.sort(key=lambda r: (identity_text(r["name"]), r["name"]))
    for a, b in zip(rows, rows[1:], strict=False):
        if identity_text(a["name"]) == identity_text(b["name"]):
            raise IngestError("semantic_validation", f"names {a['name']!r} and {b['name']!r} are the same")
    data, target = serialize(rows), Path(to)
    handle, temp = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, target)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(temp)
        raise
    return len(data)
