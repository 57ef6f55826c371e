"""All registered queries. Importing the modules registers them."""

from . import catalog_load, catalog_report, catalog_rules, catalog_text  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
