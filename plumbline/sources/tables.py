"""Parquet table access. Column pruning and filters are left to the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_existing(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """GOV-06: the first of these tables that the folder has."""
    from pyspark.errors import AnalysisException

    for name in names:
        try:
            return table(spark, sf_dir, name)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"none of {names} in {sf_dir}")
