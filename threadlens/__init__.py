"""threadlens — thread analytics for stance data sets, written as Spark jobs.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function;
planning, partitioning and execution are left to Catalyst and AQE.
"""

from threadlens.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
