"""Settings from the environment: credentials, storage, logs."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping
from logging.handlers import RotatingFileHandler

STORES = ("azure", "s3", "endpoint")


def credentials(env: Mapping[str, str] = os.environ, prefix: str = "FEED") -> list[dict[str, str]]:
    """Client ids and secrets: <prefix>_CLIENT_ID and _CLIENT_SECRET, then the same with _2, _3 and so on until one is missing."""
    out, k = [], 1
    while True:
        end = "" if k == 1 else f"_{k}"
        cid, secret = env.get(f"{prefix}_CLIENT_ID{end}", ""), env.get(f"{prefix}_CLIENT_SECRET{end}", "")
        if not (cid and secret):
            return out
        out.append({"client_id": cid, "client_secret": secret})
        k += 1


def keys(name: str, env: Mapping[str, str] = os.environ) -> list[str]:
    """Comma-separated keys of <name>_KEYS, or the single one of <name>_KEY."""
    text = env.get(f"{name}_KEYS") or env.get(f"{name}_KEY") or ""
    return [k.strip() for k in text.split(",") if k.strip()]


def storage_settings(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Hadoop settings of the first store that is configured: Azure, then S3, then another S3 endpoint; none for local folders."""
    if env.get("AZURE_STORAGE_ACCOUNT") and env.get("AZURE_STORAGE_KEY"):
        return {f"fs.azure.account.key.{env['AZURE_STORAGE_ACCOUNT']}.dfs.core.windows.net": env["AZURE_STORAGE_KEY"]}
    if env.get("AWS_ACCESS_KEY_ID") and env.get("AWS_SECRET_ACCESS_KEY"):
        out = {"fs.s3a.access.key": env["AWS_ACCESS_KEY_ID"], "fs.s3a.secret.key": env["AWS_SECRET_ACCESS_KEY"]}
        return out | ({"fs.s3a.endpoint.region": env["AWS_REGION"]} if env.get("AWS_REGION") else {})
    if env.get("STORE_ENDPOINT") and env.get("STORE_KEY_ID") and env.get("STORE_SECRET"):
        return {
            "fs.s3a.endpoint": env["STORE_ENDPOINT"], "fs.s3a.access.key": env["STORE_KEY_ID"], "fs.s3a.secret.key": env["STORE_SECRET"],
            "fs.s3a.path.style.access": "true",
        }
    return {}


def is_remote(uri: str) -> bool:
    return "://" in uri and not uri.startswith("file://")


def table_uri(root: str, name: str) -> str:
    """The place of a table; schemes are kept, s3:// is read through s3a://."""
    root = root.rstrip("/")
    return f"{'s3a' + root[2:] if root.startswith('s3://') else root}/{name}"


def logger(name: str, path: str | None = None, size: int = 5 << 20, keep: int = 5) -> logging.Logger:
    """A logger to the console, and to a rotating file if a path is given; asked for twice it is set up once."""
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    wanted = [logging.StreamHandler()] + ([RotatingFileHandler(path, maxBytes=size, backupCount=keep)] if path else [])
    if not log.handlers:
        for h in wanted:
            h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
            log.addHandler(h)
    return log
