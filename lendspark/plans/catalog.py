"""Imports every query module so that the registry is complete."""
from __future__ import annotations

import importlib

from lendspark.plans.oracle import finalise
from lendspark.plans.registry import REGISTRY

MODULES = [
    "lendspark.plans.q_features",
    "lendspark.plans.q_scoring",
    "lendspark.plans.q_audit",
    "lendspark.plans.q_scorecard",
    "lendspark.plans.q_models",
    "lendspark.plans.q_stream",
]


def load_all():
    for m in MODULES:
        importlib.import_module(m)
    return REGISTRY


def queries():
    return {name: reg.build for name, reg in load_all().items()}


def oracle_sql():
    out = {}
    for name, reg in load_all().items():
        if reg.sql is not None:
            out[name] = finalise(reg.sql())
    return out
