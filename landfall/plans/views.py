"""The star tables as SQL views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Each table under its own name, for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
