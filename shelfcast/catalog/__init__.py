"""Registered queries with their SQL counterparts on the test tables."""


def load():
    """(queries, statements) after importing every query module."""
    from shelfcast.catalog import (  # noqa: F401
        aggregates,
        calendars,
        features,
        filters,
        forecasts,
        globals,
        joins,
        publishing,
        registry,
        reports,
        sources,
    )

    return registry.QUERIES, registry.ORACLES
