"""One write that routes each row to the good or the rejected side.

The rows are read and parsed once; a ``status`` partition column sends them to two
folders of the same target, and each side is read back alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweek.sinks.files import PACKED

STATUS = "status"
GOOD, REJECTED = "good", "rejected"


def routed(df: DataFrame, ok: Column) -> DataFrame:
    """``df`` with the ``status`` of each row; a NULL condition is a reject."""
    return df.withColumn(STATUS, F.when(F.coalesce(ok, F.lit(False)), GOOD).otherwise(REJECTED))


def write_routed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", packed: bool = False) -> None:
    """Rows with their ``status``, one folder per status, in one job; ``packed`` is for text (``sinks.files``)."""
    df.write.mode(mode).partitionBy(STATUS).format(fmt).options(**(PACKED if packed else {})).save(path)


def read_routed(spark: SparkSession, path: str, schema: StructType, status: str, fmt: str = "parquet") -> DataFrame:
    """One side of a routed target; the other side's files are not opened."""
    both = StructType([*schema.fields, *StructType().add(STATUS, "string").fields])
    return spark.read.schema(both).format(fmt).load(path).where(F.col(STATUS) == status).drop(STATUS)
