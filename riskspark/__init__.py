"""riskspark: payment-risk analytics (dormancy, detection quality, dispute
key results, payment mart, attach rates) as Spark DataFrame plans.

``QUERIES`` maps analysis names to ``f(tables, params) -> DataFrame``;
``BOOKS`` computes the analyses of one worksheet together.
"""

from .params import Params
from .plans import QUERIES
from .plans.books import BOOKS
from .sources.catalog import Tables
from .sources.driver_adapter import driver_tables

__all__ = ["BOOKS", "Params", "QUERIES", "Tables", "driver_tables"]
