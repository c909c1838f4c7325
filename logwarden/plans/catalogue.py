"""All registered queries and their SQL twins."""

from __future__ import annotations

import importlib

_PARTS = ("evaluation", "profiles", "privacy", "detection", "training", "streams", "storage")


def _merged(name: str) -> dict:
    out = {}
    for part in _PARTS:
        for key, value in getattr(importlib.import_module(f"logwarden.plans.{part}"), name).items():
            if key in out:
                raise ValueError(f"{key} is registered twice")
            out[key] = value
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracles() -> dict:
    return _merged("ORACLES")
