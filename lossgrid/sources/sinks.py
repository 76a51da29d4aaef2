"""Result tables as partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_results(
    df: DataFrame, path: str, *, as_of: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write one snapshot as the folder as_of=<date>; other snapshots in the table stay.

    The folder is overwritten as a whole, so a repeated run leaves nothing of the run before, also where it fills
    fewer partitions.
    """
    df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(f"{path}/as_of={as_of}")
