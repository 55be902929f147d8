"""aerolith: a PySpark-native sensor-reading warehouse.

Every operator is a function from DataFrames to DataFrames. Writing is kept
separate (``aerolith.sources.warehouse``) so that plans stay lazy and Catalyst
sees the whole query.
"""

from aerolith.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
