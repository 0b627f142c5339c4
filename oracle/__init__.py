"""SQL for DuckDB that states the expected result of every query, written another way than the plans.

Rules are applied one after the other with anti joins (the plans use one aggregate), duplicates are
ranked with a window, fan-out joins are grouped afterwards, and rounding is done on integers.
"""

from oracle.statements import statements

__all__ = ["statements"]
