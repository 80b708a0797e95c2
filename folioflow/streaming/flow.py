"""The item flow as a stream: validate, detect changes, write, per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioflow import schemas
from folioflow.plans.site_run import RunStore, run_batch
from folioflow.rules import Rules
from folioflow.session import join_path


def read_page_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Page files as they arrive."""
    reader = spark.readStream.schema(schemas.PAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_stream(
    pages: DataFrame, rules: Rules, root: str, *, crawl_links: bool = False, skip_captcha: bool = False, **trigger
) -> StreamingQuery:
    """Start the flow; micro-batches go through the same operators as a batch run.

    The batch id is the version of everything a micro-batch writes, so a batch that is
    played again after a failure overwrites its own output and nothing else.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        store = RunStore(batch.sparkSession, root)
        run_batch(batch, rules, store, batch_id, crawl_links=crawl_links, skip_captcha=skip_captcha)

    writer = pages.writeStream.foreachBatch(on_batch).option("checkpointLocation", join_path(root, "progress"))
    return writer.trigger(**(trigger or {"availableNow": True})).start()
