"""Writing feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_features(df: DataFrame, path: str, mode: str = "errorifexists", rebalance: bool = True) -> None:
    """Parquet partitioned by layer, so reading one layer touches only its files.

    The rebalance hint gathers a layer's rows into files of the advisory size and still
    splits a layer that holds most rows over many tasks.
    """
    if rebalance:
        df = df.hint("rebalance", "layer_url")
    df.write.mode(mode).partitionBy("layer_url").parquet(path)
