"""Data-quality and star-schema warehouse engine on PySpark DataFrames."""

from starmill.plans.run import run

__all__ = ["run"]
