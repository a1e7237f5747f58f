"""Column-expression helpers shared by the operators (all JVM-side Spark built-ins)."""

from salesmart.functions.numeric import mean2, ratio_pct, round2, to_edge, total2
from salesmart.functions.parsing import lenient_int, money, parse_date, standardize

__all__ = [
    "lenient_int", "mean2", "money", "parse_date", "ratio_pct", "round2", "standardize",
    "to_edge", "total2",
]
