"""Small tables of settings as DataFrames whose size Spark knows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows of settings as a local relation: Spark sees its size and broadcasts it on its own."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    arrays = [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema=schema)
