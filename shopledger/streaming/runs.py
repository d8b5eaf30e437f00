"""Running a stream over what is there now, into a table per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.session import scratch_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(
    spark: SparkSession, path: str, schema, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over a table: a file, or a folder of part files.

    As a pattern the path may name either; a plain path has to be a folder.
    """
    if not glob:
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch below its own number; a repeated micro-batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_available(
    stream: DataFrame,
    mode: str,
    name: str,
    sink: Callable[[str], Callable[[DataFrame, int], None]] = table_sink,
) -> DataFrame:
    """Run to the end of the available input; the collected output with its ``batch_id``.

    The state store's setting is the session's own again afterwards. Without input there is no
    micro-batch, and the output is empty.
    """
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .foreachBatch(sink(out))
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    if query.lastProgress is None or not any(p.numInputRows for p in query.recentProgress):
        # The sink's own schema is known only from what it writes; an empty input may write nothing.
        sink(out)(spark.createDataFrame([], stream.schema), 0)
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))
