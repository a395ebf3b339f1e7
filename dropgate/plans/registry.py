"""Registries: ``file-name glob → rules``, from YAML or an in-memory dict.

Three kinds, as in the shipped configuration:

* ``validate``:  ``{pattern: {validators: {name: params}, schema: {col: type}}}``
* ``transform``: ``{pattern: {transforms: [{name, function, params, order}]}}``
* ``dispatch``:  ``{pattern: target_folder}``
* ``aggregate``: ``{pattern: {group_by: [cols], aggregations: {col: sum|mean|count|min|max}}}``

``Registry`` compiles on construction: every function name is looked up and
all missing ones are reported together, before any file is read (X3).
"""

from __future__ import annotations

import os
from typing import Any

import yaml

from dropgate.errors import RegistryError

KINDS = ("validate", "transform", "dispatch", "aggregate")


def load_yaml(path: str) -> dict:
    with open(path, encoding="utf-8") as fh:
        data = yaml.safe_load(fh)
    return data or {}


class Registry:
    def __init__(self, data: dict | str, kind: str):
        if kind not in KINDS:
            raise RegistryError(f"unknown registry kind '{kind}'")
        if isinstance(data, (str, os.PathLike)):
            data = load_yaml(str(data))
        if not isinstance(data, dict) or not data:
            raise RegistryError("registry is empty")
        self.kind = kind
        self.data: dict[str, Any] = data
        self._compile()

    @property
    def patterns(self) -> list[str]:
        return list(self.data)

    def rules(self, pattern: str) -> dict:
        return self.data[pattern] or {}

    @property
    def targets(self) -> dict[str, str]:
        if self.kind != "dispatch":
            raise RegistryError("targets are defined for dispatch registries only")
        return {p: str(t) for p, t in self.data.items()}

    def _compile(self) -> None:
        from dropgate.operators.checks import CHECKS
        from dropgate.operators.transforms import TRANSFORMS, compile_chain

        missing: list[str] = []
        for pattern, rules in self.data.items():
            if self.kind == "dispatch":
                if not isinstance(rules, str):
                    raise RegistryError(f"dispatch target for '{pattern}' must be a folder name")
                continue
            rules = rules or {}
            if self.kind == "aggregate":
                from dropgate.operators.aggregate import AGGREGATIONS
                if not rules.get("group_by") or not isinstance(rules.get("aggregations"), dict):
                    raise RegistryError(f"aggregate rules of '{pattern}' need group_by and aggregations")
                missing += [f for f in rules["aggregations"].values() if f not in AGGREGATIONS]
                continue
            if self.kind == "validate":
                vals = rules.get("validators") or {}
                if not isinstance(vals, dict):
                    raise RegistryError(f"validators of '{pattern}' must be a mapping")
                missing += [n for n in vals if n not in CHECKS]
            else:
                spec = rules.get("transforms") or []
                missing += [t.get("function") for t in spec if t.get("function") not in TRANSFORMS]
        if missing:
            raise RegistryError(f"Missing function(s) in registry: {sorted(set(map(str, missing)))}")
        if self.kind == "transform":
            for rules in self.data.values():
                compile_chain((rules or {}).get("transforms") or [])
