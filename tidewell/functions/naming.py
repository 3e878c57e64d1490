"""Names of topics, tables and namespaces."""

from __future__ import annotations

import re
from dataclasses import dataclass

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def checked(name: str) -> str:
    """``name`` if it is safe to stand in SQL unquoted."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


@dataclass(frozen=True)
class Target:
    """A mirror table."""

    namespace: str
    table: str

    @property
    def name(self) -> str:
        return f"{self.namespace}.{self.table}"


def _target(service: str, schema: str, table: str) -> Target:
    return Target(f"{service.lower()}_{schema.lower()}", table.lower())


def topic_target(service: str, topic: str) -> Target:
    """``prefix.schema.table`` -> ``{service}_{schema}.{table}``, lower-cased."""
    parts = topic.split(".")
    if len(parts) != 3:
        raise ValueError(f"a topic has three parts: {topic!r}")
    return _target(service, parts[1], parts[2])


def source_target(service: str, name: str) -> Target:
    """A source table of two parts (schema, table) or three (the middle one dropped)."""
    parts = name.split(".")
    if len(parts) not in (2, 3):
        raise ValueError(f"a table name has two or three parts: {name!r}")
    return _target(service, parts[0], parts[-1])
