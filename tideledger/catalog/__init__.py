"""Every operator as a checked query over the given tables."""

from importlib import import_module

_MODULES = ("scalars", "events", "relational", "balances", "revenue", "studies", "reporting", "storage")


def load():
    """All registered queries and SQL twins, in catalog order."""
    for name in _MODULES:
        import_module(f"tideledger.catalog.{name}")
    from tideledger.catalog.base import ORACLES, QUERIES

    return QUERIES, ORACLES
