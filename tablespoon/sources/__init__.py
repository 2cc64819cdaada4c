from .landing import LANDING_SCHEMAS, jdbc_options, load_landing
from .layout import Layout, read_table, write_table

__all__ = ["LANDING_SCHEMAS", "Layout", "jdbc_options", "load_landing", "read_table", "write_table"]
