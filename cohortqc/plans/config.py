"""YAML configuration with ${a.b} references."""

from __future__ import annotations

import os
import re
from pathlib import Path
from typing import Any

import yaml

VARIABLE = "COHORTQC_CONFIG"
_REF = re.compile(r"\$\{([^}]+)\}")


def _lookup(tree: dict, path: str) -> Any:
    node: Any = tree
    for part in path.split("."):
        node = node[part]
    return node


def resolve(tree: dict) -> dict:
    """Replaces every reference; a value that is nothing but one reference keeps the type of its target."""

    def value(v: Any, seen: tuple[str, ...]) -> Any:
        if isinstance(v, dict):
            return {k: value(x, seen) for k, x in v.items()}
        if isinstance(v, list):
            return [value(x, seen) for x in v]
        if not isinstance(v, str):
            return v

        def target(path: str) -> Any:
            if path in seen:
                raise ValueError(f"references in a circle: {' -> '.join((*seen, path))}")
            return value(_lookup(tree, path), (*seen, path))

        if whole := _REF.fullmatch(v):
            return target(whole[1])
        return _REF.sub(lambda m: str(target(m[1])), v)

    return value(tree, ())


def find(path: str | None = None, folder: str | Path = "config") -> Path:
    """The argument, else the environment variable (absolute or ./ as it is, otherwise inside the folder), else inputs.yaml there."""
    if path is not None:
        return Path(path)
    name = os.environ.get(VARIABLE)
    if name and (name.startswith("/") or name.startswith("./")):
        return Path(name)
    return Path(folder) / (name or "inputs.yaml")


def load(path: str | None = None, folder: str | Path = "config") -> dict:
    return resolve(yaml.safe_load(find(path, folder).read_text()))
