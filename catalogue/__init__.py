"""Named queries over the test tables, each with its equivalent SQL where there is one."""

from importlib import import_module

MODULES = ("scalars", "medallion", "relational", "stateful", "costs")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"catalogue.{name}")
