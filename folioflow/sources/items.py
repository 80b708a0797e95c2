"""Content items as JSON datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.schemas import ITEM


def read_items(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Items from pretty-printed one-object files (``multi_line``) or JSON lines."""
    schema = T.StructType(ITEM.fields + [T.StructField("file_name", T.StringType())])
    reader = spark.read.schema(schema).option("recursiveFileLookup", "false")
    return reader.option("multiLine", multi_line).json(path)


def write_items(items: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines partitioned by brand and content type; absent values leave no key.

    ``_scraped_at`` is written as ISO-8601 UTC. Partition columns stay out of the
    records and come back on reading.
    """
    stamped = items.withColumn("_scraped_at", F.date_format("_scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    stamped.write.mode(mode).partitionBy("brand", "content_type").option("ignoreNullFields", "true").json(path)
