"""JDBC publish.

The table name comes from a config mapping by key (or an explicit override);
credentials come from the caller / environment, never from the config file.
A missing key skips the publish with a warning; write errors propagate.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "overwrite",
               driver: str | None = None, user: str | None = None,
               password: str | None = None, num_partitions: int | None = None,
               batch_size: int = 10000) -> None:
    """Write ``df`` to a JDBC table from the executors.  ``num_partitions``
    caps concurrent connections (coalesce, no shuffle)."""
    props = {"batchsize": str(batch_size)}
    if driver:
        props["driver"] = driver
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=props)


def publish(df: DataFrame, config: Mapping[str, str], table_key: str,
            table_name: str | None = None, *, password_env: str = "JDBC_PASSWORD") -> bool:
    """Publish ``df`` to the table named by ``config[table_key]`` (or
    ``table_name``).  ``config`` carries ``url`` and optionally ``driver``,
    ``user``, ``mode``.  Returns False when the table key is missing."""
    table = table_name or config.get(table_key)
    if not table:
        log.warning("no table configured for %s; publish skipped", table_key)
        return False
    write_jdbc(df, config["url"], table, mode=config.get("mode", "overwrite"),
               driver=config.get("driver"), user=config.get("user"),
               password=os.environ.get(password_env))
    return True
