"""python -m siltlake [CONFIG]: run the configured stream until it is stopped. LOG_LEVEL sets the log level."""

from __future__ import annotations

import logging
import os
import sys

from pyspark.sql import SparkSession

from siltlake import config, observe
from siltlake.sources import kafka
from siltlake.streaming import buffer, ingest


def main(args: list[str]) -> None:
    handler = logging.StreamHandler()
    handler.setFormatter(observe.JsonLines())
    logging.basicConfig(level=observe.log_level(os.environ.get("LOG_LEVEL")), handlers=[handler])
    c = config.load(args[0] if args else "config.yml")
    spark = SparkSession.builder.appName("siltlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.streams.addListener(observe.Progress())
    observe.METRICS.serve(c.metrics_port)
    query = ingest.start(kafka.stream(spark, c.source(), buffer.offsets_per_trigger(c.buffer)), c, os.path.join(c.data_dir, "checkpoint"))
    query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
