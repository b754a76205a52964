"""Named queries: each operator of the inventory as a runnable plan + its DuckDB twin."""

from docforge.plans import documents_q  # noqa: F401  (registers queries)
from docforge.plans.registry import REGISTRY


def load_all():
    """Import every query module so that the registry is complete."""
    import importlib
    import pkgutil

    import docforge.plans as pkg

    for mod in pkgutil.iter_modules(pkg.__path__):
        if mod.name.endswith("_q"):
            importlib.import_module(f"docforge.plans.{mod.name}")
    return REGISTRY
