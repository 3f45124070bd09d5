"""All registered queries; importing this package fills the registry."""

import importlib
import pkgutil

from brisa.catalog.base import QUERIES, SQL

for _m in pkgutil.iter_modules(__path__):
    if _m.name.endswith("_queries"):
        importlib.import_module(f"{__name__}.{_m.name}")

__all__ = ["QUERIES", "SQL"]
