from .roll_forward import roll_forward
from .warehouse import GOLD_TABLES, PARTITIONS, SOURCE_TABLES, Warehouse, build_all, failed_checks

__all__ = ["GOLD_TABLES", "PARTITIONS", "SOURCE_TABLES", "Warehouse", "build_all", "failed_checks", "roll_forward"]
