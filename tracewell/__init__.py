"""Payment-fraud and anti-money-laundering analytics as Spark DataFrame jobs."""

from tracewell.params import Params
from tracewell.sources.tables import Tables

__all__ = ["Params", "Tables"]
