"""Stream sources, sinks and the lifecycle of a set of queries."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tripgrid.operators.state import latest_per_key

# ---- sources ----------------------------------------------------------------------------


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest"):
    """Message stream of a topic; the connector package must be on the session."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
    )


def file_source(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the files under ``path``, oldest first."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


# ---- sinks ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sink:
    """What a stream writes to: a format with its options, and the folders it is split into."""

    fmt: str
    options: dict[str, object] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()


def console(rows: int = 10) -> Sink:
    """Shows the first ``rows`` rows of a batch; no task sends the driver more than one beyond them."""
    return Sink("console", {"truncate": False, "numRows": rows})


def _first_of_task(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Passes on the first ``rows`` rows of a task and reads the others to their end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = rows
        for batch in batches:
            if left:
                head = batch.slice(0, left)
                left -= head.num_rows
                yield head

    return cut


def parquet(path: str, partition_by: tuple[str, ...] = ()) -> Sink:
    """Files cannot be updated, so aggregates reach them once their watermark has passed."""
    return Sink("parquet", {"path": path}, partition_by)


def kafka(servers: str, topic: str) -> Sink:
    """For frames with message keys and values, see ``events.to_messages``."""
    return Sink("kafka", {"kafka.bootstrap.servers": servers, "topic": topic})


def _started(writer: DataStreamWriter, checkpoint: str | None, every: str | None):
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def start(
    df: DataFrame, sink: Sink, checkpoint: str | None = None, mode: str = "append",
    every: str | None = "30 seconds",
) -> StreamingQuery:
    """Start one query; ``every`` is the micro-batch interval, None runs over what is there.

    A split sink gets the rows of a folder in one task per batch, so a batch writes one file
    per folder and not one per task and folder. The console format gathers all rows of a batch in
    the driver, so it gets as many of each task as it may show, and one that tells it of more.
    """
    if sink.partition_by:
        df = df.repartition(*sink.partition_by)
    if sink.fmt == "console":
        df = df.mapInArrow(_first_of_task(int(sink.options.get("numRows", 20)) + 1), df.schema)
    writer = df.writeStream.outputMode(mode).format(sink.fmt).options(**sink.options)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    return _started(writer, checkpoint, every)


def to_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", every: str | None = "10 seconds",
) -> StreamingQuery:
    return _started(df.writeStream.outputMode(mode).foreachBatch(handle), checkpoint, every)


def _run_name() -> str:
    """Names of runs sort by the time they began."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def scoring_handler(
    score: Callable[[DataFrame], DataFrame], path: str
) -> Callable[[DataFrame, int], None]:
    """Batch handler that scores a non-empty batch and writes it below ``path``.

    A batch owns the folder of its run and number: a replay within a run overwrites, and a run
    that begins again with a new checkpoint touches nothing of the runs before.
    """
    run = _run_name()

    def handle(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            score(batch).write.mode("overwrite").parquet(f"{path}/run={run}/epoch={epoch}")

    return handle


def spread_handler(
    path: str, keys: tuple[str, ...], rows_per_file: int = 1_000_000, rows_per_task: int = 50_000
) -> Callable[[DataFrame, int], None]:
    """Batch handler that writes a batch split by ``keys``, a hot key in as many tasks as it fills.

    A key with more than ``rows_per_file`` rows is hot. It is dealt over one task for each
    ``rows_per_task`` rows (or ``rows_per_file`` if that is more), and a task begins a new file
    after ``rows_per_file`` rows: small files cost files, not tasks. How many tasks a key needs
    follows from the batch before, whose counts come from what it wrote and are read when the next
    batch comes; the first batch of a run is counted beforehand. At most rows / ``rows_per_file``
    keys are hot, so the list of them is short.
    """
    run = _run_name()
    before: str | None = None

    def needs(rows: DataFrame) -> list[tuple]:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_file)
        share = max(rows_per_file, rows_per_task)
        return [(*values, -(-n // share)) for *values, n in counts.collect()]

    def handle(batch: DataFrame, epoch: int) -> None:
        nonlocal before
        spark = batch.sparkSession
        hot = needs(batch if before is None else spark.read.schema(batch.schema).parquet(before))
        parts = F.lit(1)
        # a stated number of tasks is not merged, and few parts of hot keys meet in one
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) + 2 * sum(n for *_, n in hot)
        for *values, n in hot:
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, values)])
            parts = F.when(same, F.lit(n)).otherwise(parts)
        dealt = batch.withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts))
        target = f"{path}/run={run}/epoch={epoch}"
        writer = dealt.repartition(tasks, *keys, "_part").drop("_part").write.mode("overwrite").partitionBy(*keys)
        writer.option("maxRecordsPerFile", rows_per_file).parquet(target)
        before = target

    return handle


# ---- latest row per key -----------------------------------------------------------------


def changelog_handler(path: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that writes the newest row per key of each batch below ``path``.

    A batch writes only keys it touched and only the folder of its run and number, so a replay
    is harmless, a restart erases nothing, and no batch reads or rewrites the whole state.
    ``read_state`` merges the folders.
    """
    run = _run_name()

    def handle(batch: DataFrame, epoch: int) -> None:
        target = f"{path}/run={run}/epoch={epoch}"
        latest_per_key(batch, key, order).write.mode("overwrite").parquet(target)

    return handle


def read_state(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """Newest row per key over all batches; of equal ``order`` the row written last counts."""
    log = spark.read.parquet(path)
    return latest_per_key(log, key, order, "run", "epoch").drop("run", "epoch")


def compact_state(spark: SparkSession, path: str, target: str, key: str, order: str) -> None:
    """Write the merged state of ``path`` as the first run of a new changelog.

    The name of that run sorts before all others, so what a stream writes to ``target`` from
    now on wins ties.
    """
    merged = read_state(spark, path, key, order)
    merged.write.mode("overwrite").parquet(f"{target}/run={0:020d}-merged/epoch=0")


# ---- lifecycle --------------------------------------------------------------------------


def await_all(queries: list[StreamingQuery], seconds: float | None = None) -> None:
    """Wait until all queries have ended or ``seconds`` have passed, then stop what still runs.

    The first failure, of whichever query, stops the others and is raised.
    """
    deadline = None if seconds is None else time.monotonic() + seconds
    try:
        while running := [q for q in queries if q.isActive or q.exception()]:
            for query in running:
                query.awaitTermination(0.2)  # raises what the query failed with
            if deadline is not None and time.monotonic() >= deadline:
                break
    finally:
        for query in queries:
            query.stop()


class ProgressTotals(StreamingQueryListener):
    """Batches, input rows and best rate of every query since the listener was added.

    A query itself remembers its last hundred updates only.
    """

    def __init__(self) -> None:
        self.seen: dict[str, dict[str, float]] = {}

    def onQueryStarted(self, event) -> None:
        self.seen.setdefault(str(event.runId), {"batches": 0, "input_rows": 0, "rate": 0.0, "last": -1})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = self.seen.setdefault(
            str(p.runId), {"batches": 0, "input_rows": 0, "rate": 0.0, "last": -1}
        )
        if p.batchId > total["last"]:
            total["batches"] += 1
        total["input_rows"] += p.numInputRows
        total["rate"] = max(total["rate"], p.processedRowsPerSecond or 0.0)
        total["last"] = max(total["last"], p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch_progress(spark: SparkSession) -> ProgressTotals:
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    return totals


def progress_summary(
    query: StreamingQuery, totals: ProgressTotals, patience: float = 10.0
) -> dict[str, float]:
    """Batches and input rows so far, and whether anything was processed.

    Updates reach the listener a moment late; this waits for the query's last one.
    """
    last = query.lastProgress
    deadline = time.monotonic() + patience
    found = {"batches": 0, "input_rows": 0, "rate": 0.0, "last": -1}
    while True:
        found = totals.seen.get(str(query.runId), found)
        if last is None or found["last"] >= last["batchId"]:
            break
        if time.monotonic() >= deadline:
            raise TimeoutError("the progress listener missed the query's last batch")
        time.sleep(0.05)
    return {
        "batches": found["batches"],
        "input_rows": found["input_rows"],
        "rows_per_second": found["rate"],
        "active": found["batches"] > 0 or found["input_rows"] > 0,
    }
