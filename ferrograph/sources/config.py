"""Settings of an extraction run, checked when they are made, and the classes of requests they allow."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import MISSING, dataclass, fields
from types import MappingProxyType
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.addresses import resolved_path


class ConfigError(ValueError):
    code = "configuration"


def url_path(url: str) -> str:
    """Resolved path of an address; a backslash in it, escaped or not, or a null character isn't allowed."""
    path = urlsplit(url).path
    resolved = resolved_path(path)
    if resolved is None or "\\" in path or re.search("%(?:25){0,2}5c", path, re.I):
        raise ConfigError(f"path of {url!r}")
    return resolved.rstrip("/") or "/"


def _endpoint(name: str, url: str) -> None:
    parts = urlsplit(url)
    if parts.scheme != "https" or not parts.hostname or parts.username or parts.password or parts.fragment:
        raise ConfigError(f"{name} must be a plain https address")


@dataclass(frozen=True)
class Config:
    """Endpoints, contact, bounds; ``nations`` empty means all."""

    api: str
    guide_root: str
    contact: str
    root_category: str
    nations: tuple[str, ...] = ()
    attempts: int = 5
    body_bytes: int = 10 << 20
    interval: float = 5.0

    def __post_init__(self):
        _endpoint("api", self.api)
        _endpoint("guide_root", self.guide_root)
        if not re.search(r"\S+@\S+\.\S+|https?://\S+", self.contact) or re.search(r"[\r\n]", self.contact):
            raise ConfigError("contact must name an address and stand in one line")
        if not self.root_category.strip():
            raise ConfigError("root_category is blank")
        if not 1 <= self.attempts <= 5 or not 1 <= self.body_bytes <= 10 << 20 or self.interval < 5:
            raise ConfigError("attempts are 1 to 5, bodies at most 10 MiB, intervals at least 5 s")

    @classmethod
    def of(cls, given: Mapping[str, object], environment: Mapping[str, str] = MappingProxyType({})) -> Config:
        """From what is given, else from variables ``FERROGRAPH_`` and the setting's name in capitals; nations are separated by commas there. What neither has keeps its default, or is an error."""
        values: dict[str, object] = {}
        for f in fields(cls):
            stated = environment.get(f"FERROGRAPH_{f.name.upper()}")
            if given.get(f.name) not in (None, ()):
                values[f.name] = given[f.name]
            elif stated:
                try:
                    values[f.name] = tuple(x.strip() for x in stated.split(",") if x.strip()) if f.name == "nations" else type(f.default)(stated) if f.default is not MISSING else stated
                except ValueError:
                    raise ConfigError(f"{f.name} is {stated!r}") from None
            elif f.default is MISSING:
                raise ConfigError(f"{f.name} isn't given")
        return cls(**values)

    def classify(self, url: str) -> str | None:
        """``robots``, ``wiki`` or ``guide``; null for an address outside the boundary."""
        parts = urlsplit(url)
        if parts.scheme != "https" or parts.username or parts.password:
            return None
        path = url_path(url)
        if parts.hostname in (urlsplit(self.api).hostname, urlsplit(self.guide_root).hostname) and path == "/robots.txt":
            return "robots"
        if parts.hostname == urlsplit(self.api).hostname and path == url_path(self.api):
            return "wiki"
        root = url_path(self.guide_root).rstrip("/")
        if parts.hostname == urlsplit(self.guide_root).hostname and (path == root or path.startswith(root + "/")):
            return "guide"
        return None


def nation_filter(c: Column, nations: tuple[str, ...]) -> Column:
    """Whether a record's nation is wanted; no list, or ALL in it, wants every one."""
    return F.lit(True) if not nations or "ALL" in nations else F.coalesce(c.isin(*nations), F.lit(False))
