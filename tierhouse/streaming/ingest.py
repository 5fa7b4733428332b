"""Incremental file ingestion: every file is loaded once, by its own header, under the rules of its table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.quality import DROP, Rule, apply_rules, rule_counts, survives, violated
from ..sources.files import literal, read_csv
from ..sources.schemas import SOURCES, Source

BATCH = "_batch"
VIOLATED = "_violated"
# Files of a batch, unless another number is given; their paths and headers come to the driver.
FILES_PER_BATCH = 1000


@dataclass(frozen=True)
class Sink:
    """A table, or a parquet folder, with one partition per batch of a stream."""

    table: str | None = None
    path: str | None = None

    def __post_init__(self) -> None:
        if (self.table is None) == (self.path is None):
            raise ValueError("give a table or a path")

    def put(self, rows: DataFrame, batch: int) -> None:
        """Write the rows of a batch in place of those an earlier, failed try may have left."""
        spark = rows.sparkSession
        if self.path:
            rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")
            return
        if not spark.catalog.tableExists(self.table):
            kind = rows.schema.add(BATCH, T.LongType())
            spark.createDataFrame([], kind).write.partitionBy(BATCH).format("parquet").saveAsTable(self.table)
        name = f"batch_{batch}_of_{self.table.replace('.', '_')}"
        rows.createOrReplaceTempView(name)
        spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH} = {batch}) SELECT * FROM {name}")
        spark.catalog.dropTempView(name)


def put_checked(
    rows: DataFrame, batch: int, rules: Sequence[Rule], target: Sink, quarantine: Sink | None = None,
    metrics: Sink | None = None,
) -> dict[str, int]:
    """Write a batch under rules; returns checked rows and violations by rule.

    The counts are observed while the rows that pass are written. Rows that a drop rule takes out go to ``quarantine``
    with the names of the rules they violate (a second pass, made only if there are any), the counts to ``metrics``. A
    violated fail rule raises, and the batch counts as not loaded.
    """
    kept, observation = apply_rules(rows, rules)
    target.put(kept, batch)
    counts = observation.get
    if quarantine:
        dropped = rows.where(~survives(rules)).withColumn(VIOLATED, violated(rules))
        if not any(counts[r.name] for r in rules if r.action == DROP):
            dropped = rows.sparkSession.createDataFrame([], dropped.schema)
        quarantine.put(dropped, batch)
    if metrics:
        metrics.put(rule_counts(rows.sparkSession, rules, counts), batch)
    return counts


def run_batches(stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> None:
    """Hand everything that is new to ``process``, batch by batch, then stop.

    The checkpoint folder remembers what was handed over, so it must outlive the job and belong to one target. A batch
    that fails comes again with the same number and rows, so ``process`` has to replace what it wrote under that number.
    """
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_rules(
    stream: DataFrame, rules: Sequence[Rule], checkpoint: str, target: Sink, quarantine: Sink | None = None,
    metrics: Sink | None = None,
) -> None:
    """Append the new rows of any stream under rules, then stop; see ``put_checked`` for the three sinks."""

    def put(rows: DataFrame, batch: int) -> None:
        put_checked(rows, batch, rules, target, quarantine, metrics)

    run_batches(stream, checkpoint, put)


def stream_files(
    spark: SparkSession, folder: str, file_glob: str | None = None, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of the paths of the files in ``folder`` whose names match ``file_glob``; no content is read."""
    reader = spark.readStream.format("binaryFile").schema(
        "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    )
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.option("maxFilesPerTrigger", str(files_per_batch)).load(folder).select("path")


def ingest_files(
    spark: SparkSession, folder: str, schema: str, checkpoint: str, target: Sink, file_glob: str | None = None,
    files_per_batch: int = FILES_PER_BATCH, bad_records: str = "keep", rules: Sequence[Rule] = (),
    quarantine: Sink | None = None, metrics: Sink | None = None,
) -> None:
    """Load the CSV files that are not loaded yet, with load time and source file, then stop.

    Each file is read by its own header, as in ``read_csv``, whenever it arrives. Rows that do not fit are kept with
    their line or fail the batch. ``rules`` hold for the rows as they are read (``put_checked``).
    """

    def load(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.collect()]  # at most files_per_batch
        rows = read_csv(files.sparkSession, [literal(p) for p in paths], schema, bad_records=bad_records, metadata=True)
        put_checked(rows, batch, rules, target, quarantine, metrics)

    run_batches(stream_files(spark, folder, file_glob, files_per_batch), checkpoint, load)


def ingest_sources(
    spark: SparkSession,
    folders: dict[str, str],
    database: str,
    checkpoints: str,
    sources: Iterable[Source] = SOURCES,
    files_per_batch: int = FILES_PER_BATCH,
    rules: Mapping[str, Sequence[Rule]] | None = None,
) -> None:
    """Load new files of every source into its bronze table; ``folders`` maps systems to folders.

    Tables with ``rules`` get a table of counts, ``<table>_rules``, and one of dropped rows, ``<table>_dropped``.
    """
    for source in sources:
        name = f"{database}.{source.table}"
        own = tuple((rules or {}).get(source.table, ()))
        ingest_files(
            spark, folders[source.system], source.schema, f"{checkpoints}/{source.table}", Sink(name), source.file,
            files_per_batch, rules=own, quarantine=Sink(f"{name}_dropped") if own else None,
            metrics=Sink(f"{name}_rules") if own else None,
        )
