"""The registered queries: each operator and report on the star-schema test tables, with its SQL check."""

from types import ModuleType


def load() -> ModuleType:
    """Import every module that registers queries and return the registry."""
    from acadmetric.catalog import governance, registry, relational, reports, scalars, windows  # noqa: F401

    return registry
