"""Cut lineage of small derived tables in the folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from perptide.session import checkpoint_dir


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it from there.

    For dimension-sized results that a plan uses several times. The files outlive
    a lost executor, and reading them back gives the planner their true size, so a
    join with a small one is broadcast without a shuffle of the other side and a
    join with a large one is not.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/perptide-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
