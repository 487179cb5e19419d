"""Import every query module so the registry is complete."""

from __future__ import annotations

import importlib

MODULES = [
    "kestrel.plans.q_scoring",
    "kestrel.plans.q_eda",
    "kestrel.plans.q_load",
    "kestrel.plans.q_star",
    "kestrel.plans.q_features",
]


def load() -> None:
    for m in MODULES:
        importlib.import_module(m)


load()
