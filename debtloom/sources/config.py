"""Settings: files of a run, rules out of them, and secrets from the environment. Read by the driver; small by nature."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from functools import lru_cache


@lru_cache(maxsize=32)
def load(path: str) -> dict:
    """A YAML file as a dictionary, read once; an empty file is an empty one."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def rules(blocks: Mapping[str, Mapping]) -> list[tuple[str, str, str]]:
    """``(pattern, category, reason)`` of blocks ``category: {reason, patterns}`` in order; plain words count as whole words, what has signs of a pattern is one."""
    out = []
    for category, block in blocks.items():
        for p in block.get("patterns") or ():
            out.append((p if re.search(r"[\\^$]", p) else rf"\b{re.escape(p)}\b", category, block.get("reason", category)))
    return out


def secret(name: str, required: bool = False) -> str | None:
    """A secret from the environment; blank is none."""
    found = os.environ.get(name, "").strip() or None
    if required and not found:
        raise KeyError(f"{name} is not set")
    return found
