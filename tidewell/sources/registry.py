"""Schema registries: an id's schema text, looked up once per process."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Mapping
from typing import Protocol


class SchemaRegistry(Protocol):
    def schema(self, schema_id: int) -> str: ...


class HttpRegistry:
    """A registry that serves ``/schemas/ids/{id}``."""

    def __init__(self, url: str, timeout_s: float = 10) -> None:
        self.url, self.timeout_s, self._known = url.rstrip("/"), timeout_s, {}

    def schema(self, schema_id: int) -> str:
        if schema_id not in self._known:
            with urllib.request.urlopen(f"{self.url}/schemas/ids/{int(schema_id)}", timeout=self.timeout_s) as answer:
                self._known[schema_id] = json.load(answer)["schema"]
        return self._known[schema_id]


class FixedRegistry:
    """Schemas that are given."""

    def __init__(self, schemas: Mapping[int, str | Mapping]) -> None:
        self._known = {k: v if isinstance(v, str) else json.dumps(v) for k, v in schemas.items()}

    def schema(self, schema_id: int) -> str:
        return self._known[schema_id]
