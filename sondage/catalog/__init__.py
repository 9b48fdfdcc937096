"""The queries registered for the given tables."""

from importlib import import_module

MODULES = ("shapes", "cohorts", "scores", "summaries", "tests_and_models")


def load():
    """Import every module of queries and return the registry."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
