"""Every driver query with the SQL it must equal."""

import importlib

from starsift.queries.registry import REGISTRY

MODULES = ["sources", "cleaning", "features", "rollups", "explore", "corpus", "entities", "vectors", "modelling", "runs"]


def load():
    for m in MODULES:
        importlib.import_module(f"starsift.queries.{m}")
    return REGISTRY
