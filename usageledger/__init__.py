"""Usage, cost and access reporting on Spark DataFrames."""

from usageledger.context import ReportContext

__all__ = ["ReportContext"]
