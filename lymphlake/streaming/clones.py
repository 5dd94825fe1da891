"""Clone counts that follow a folder of rearrangement files as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lymphlake.functions.seq import gene_of


def rearrangement_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def running_clones(table: DataFrame) -> DataFrame:
    """``v_gene, j_gene, junction, clone_count, abundance`` of the good rows so far, for update or complete mode.

    State is one row a clone, keyed as in the batch operator, so it grows with
    the number of clones and not with that of reads.
    """
    good = table.where((F.col("status") == "good") & (F.length("junction") >= 15))
    return good.groupBy(gene_of(F.col("v_call")).alias("v_gene"), gene_of(F.col("j_call")).alias("j_gene"), "junction").agg(F.count(F.lit(1)).alias("clone_count"), F.sum("duplicate_count").alias("abundance"))
