"""tessera: retail and text analytics as lazy Spark DataFrame operators.

Every public operator is a function ``f(df, ...) -> DataFrame`` (or builds one
from a SparkSession).  Nothing in the library collects data to the driver;
results are returned as DataFrames and materialised only by the caller.

    from tessera import get_spark
    from tessera.plans import retail
    from tessera.sources import adapters
"""

from tessera.session import clear_scratch, get_spark, scratch_root

__all__ = ["clear_scratch", "get_spark", "scratch_root"]
