"""Settings from arguments, environment, a .env file, a secret store and secret files, in that order of precedence."""

from __future__ import annotations

import json
import os
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

SECTIONS = ("vault", "database", "storage", "kafka", "polaris")


def nested(flat: Mapping[str, str]) -> dict:
    """``SECTION__NAME=value`` pairs by section; other names are ignored."""
    out: dict[str, dict[str, str]] = {}
    for key, value in flat.items():
        section, _, name = key.lower().partition("__")
        if name and section in SECTIONS:
            out.setdefault(section, {})[name] = value
    return out


def dotenv(text: str) -> dict[str, str]:
    pairs = (line.strip().removeprefix("export ").partition("=") for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, _, v in pairs}


def secret_files(folder: str | None) -> dict[str, str]:
    """Files named like variables, with their values as contents."""
    return {p.name: p.read_text().strip() for p in Path(folder).iterdir() if p.is_file()} if folder and Path(folder).is_dir() else {}


def vault_database(config: Mapping[str, str], opener: Callable = urllib.request.urlopen) -> dict[str, str]:
    """Host, port, user and password of the database, by an AppRole login."""
    missing = [k for k in ("url", "username", "password", "secret_path") if not config.get(k)]
    if missing:
        raise ValueError(f"vault settings lack {', '.join(missing)}")
    url = config["url"].rstrip("/")
    login = urllib.request.Request(f"{url}/v1/auth/approle/login", json.dumps({"role_id": config["username"], "secret_id": config["password"]}).encode(), method="POST")
    with opener(login) as answer:
        token = json.load(answer)["auth"]["client_token"]
    with opener(urllib.request.Request(f"{url}/v1/{config['secret_path'].lstrip('/')}", headers={"X-Vault-Token": token})) as answer:
        secret = json.load(answer)["data"]["data"]
    return {k: str(secret[k]) for k in ("host", "port", "user", "password") if secret.get(k) is not None}


@dataclass(frozen=True)
class Settings:
    database: dict = field(default_factory=dict, repr=False)
    storage: dict = field(default_factory=dict)
    kafka: dict = field(default_factory=dict)
    polaris: dict = field(default_factory=dict, repr=False)
    vault: dict = field(default_factory=dict, repr=False)

    @property
    def catalog(self) -> str:
        return self.storage["catalog"]

    @property
    def warehouse(self) -> str:
        return f"s3a://{self.storage['bucket']}{self.storage.get('data_path', '')}"

    @classmethod
    def load(
        cls, env_file: str | None = ".env", secrets: str | None = None, environ: Mapping[str, str] | None = None,
        fetch: Callable[[Mapping[str, str]], dict[str, str]] | None = vault_database, **given: dict,
    ) -> Settings:
        """``fetch`` None: no secret store."""
        file = dotenv(Path(env_file).read_text()) if env_file and Path(env_file).exists() else {}
        layers = [nested(secret_files(secrets)), {}, nested(file), nested(os.environ if environ is None else environ), given]
        config = {**layers[2].get("vault", {}), **layers[3].get("vault", {}), **given.get("vault", {})}
        if fetch is not None:
            layers[1] = {"database": fetch(config)}
        return cls(**{s: {k: v for layer in layers for k, v in layer.get(s, {}).items()} for s in SECTIONS})
