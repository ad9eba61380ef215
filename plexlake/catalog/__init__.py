"""All registered queries and their checking SQL."""

from plexlake.catalog.registry import ORACLES, QUERIES


def _load() -> None:
    from plexlake.catalog import annotation, feature_arrays, quality, statistics, tables  # noqa: F401


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
