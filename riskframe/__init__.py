"""riskframe: labelled-table analytics on PySpark DataFrames."""

from riskframe.roles import Roles

__all__ = ["Roles"]
