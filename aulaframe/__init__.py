"""aulaframe: Spark-native analytics for public-education data.

Every operator is a plain function DataFrame -> DataFrame built from Spark
SQL expressions, windows, joins and ``pyspark.ml``; nothing is collected to
the driver except tiny parameter tables (bounded by the number of groups or
partitions, never by the number of rows).
"""

from aulaframe.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
