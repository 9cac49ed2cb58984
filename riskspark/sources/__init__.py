from .catalog import LOGICAL_TABLES, Tables
from .driver_adapter import driver_tables

__all__ = ["LOGICAL_TABLES", "Tables", "driver_tables"]
