"""Query plans over the given tables, one module per operator family."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every ``q_*`` module so its queries register."""
    for module in pkgutil.iter_modules(__path__):
        if module.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{module.name}")
