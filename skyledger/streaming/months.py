"""Monthly file drops as Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.sources.writers import add_versions

#: A drop folder names the version of all months in it.
DROP = r"/drop=([^/]+)/"


def watch_months(spark: SparkSession, folder: str, ddl: str, max_files: int | None = None, version: str = DROP) -> DataFrame:
    """New CSV files of a folder (sub-folders included), with the ``version`` they belong to.

    ``version`` is a pattern whose first group is cut from the file's path, such as a drop folder or a part of
    the file name. Files without it are of one version, the empty one. ``max_files`` only sets how much is read at once.
    A file whose header has other names, or the same in another order, fails the batch: columns go by position in a stream.
    """
    reader = spark.readStream.schema(ddl).option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    frame = reader.option("pathGlobFilter", "*.csv").csv(folder)
    named = frame.toDF(*[c.lower() for c in frame.columns])
    return named.select("*", F.regexp_extract("_metadata.file_path", version, 1).alias("version"))


def load_months(frame: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Add every row to its month and version; a batch that is repeated after a failure replaces itself.

    A load is known by the query's id, which its checkpoint keeps over restarts, and the batch. So streams with checkpoints of
    their own, or a stream whose checkpoint was lost, add to one target without replacing each other's rows.
    ``read_months`` then shows each month in its first version (months are appended once; later files
    of that version still count) or in its newest one (a month dropped again replaces the earlier one, and late files of
    older versions are ignored).
    """
    def load(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        add_versions(batch, target, number, run)

    return frame.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
