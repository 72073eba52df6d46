"""Price files as they land: a file stream that upserts each batch and stops when nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import fixed_values as fixed
from tidemark.plans.ingest import store_prices
from tidemark.sources.bronze import typed_prices

TEXT_SCHEMA = ", ".join(f"{c} string" for c in fixed.PRICE_COLUMNS)


def keep_table_current(spark: SparkSession, raw: str, lake: str, progress: str) -> None:
    """Read every price file not seen before and merge it into the price and quarantine tables.

    A file is taken once, and merging is idempotent, so a run broken off may be repeated; late files and
    corrections update the days they belong to.
    """
    files = (spark.readStream.schema(TEXT_SCHEMA).option("header", True).option("ignoreLeadingWhiteSpace", True)
             .option("ignoreTrailingWhiteSpace", True).csv(f"{raw}/nse_bhavcopy"))

    def merge(batch: DataFrame, _: int) -> None:
        store_prices(typed_prices(batch), lake)

    (files.writeStream.foreachBatch(merge).option("checkpointLocation", progress)
     .trigger(availableNow=True).start().awaitTermination())
