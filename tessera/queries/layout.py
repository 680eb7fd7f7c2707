"""LAY: layout operators change partitioning, never rows."""

from __future__ import annotations

from tessera.queries import register
from tessera.sources.tables import table as T


@register("lay_repartition", "SELECT * FROM customer")
def lay_repartition(spark, sf):
    return T(spark, sf, "customer").repartition(2 * spark.sparkContext.defaultParallelism)


@register("lay_repartition_key", "SELECT * FROM customer")
def lay_repartition_key(spark, sf):
    return T(spark, sf, "customer").repartition("c_custkey")


@register("lay_coalesce", "SELECT * FROM lineitem")
def lay_coalesce(spark, sf):
    # As many partitions as tasks can run at once.
    return T(spark, sf, "lineitem").coalesce(spark.sparkContext.defaultParallelism)
