"""School-performance analytics as Spark DataFrame functions.

Every function takes DataFrames and returns a DataFrame. The caller makes the session.
"""

from boletim.plans.etl import Summary, run_pipeline
from boletim.plans.queries import NAMED_QUERIES
from boletim.warehouse import Warehouse, to_warehouse

__all__ = ["NAMED_QUERIES", "Summary", "Warehouse", "run_pipeline", "to_warehouse"]
