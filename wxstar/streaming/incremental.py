"""Daily incremental ingest as a file-source stream.

New or regenerated yearly observation files land in a folder; a streaming query with
``trigger(availableNow=True)`` picks up every file not yet processed (tracked in the
checkpoint). ``foreachBatch`` notes which years the new files hold (file, year, rows) in a manifest,
then reads the landed files that the manifest has for the touched years, and no others, and replaces exactly those years. So a
year spread over several files, or over several micro-batches, keeps all its rows; a batch costs the years it touches, not the
landing; a replayed batch overwrites its own part of the manifest and
rewrites the same years with the same rows, and the result is exactly-once.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxstar.functions.scalar import parse_obs_date, year_in_path
from wxstar.operators.observations import prepare_observations
from wxstar.plans import jobs
from wxstar.schemas import CORE_ELEMENTS, DEFAULT_COUNTRY, OBSERVATION_SCHEMA
from wxstar.session import scratch_dir
from wxstar.sources.files import read_observations, with_source_year


def observation_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of headerless observation CSV files with the fixed schema, with the
    file and split of each row so a batch resolves repeated cells in file order."""
    r = spark.readStream.schema(OBSERVATION_SCHEMA).option("header", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(landing_dir).withColumns({
        "src_file": F.col("_metadata.file_path"),
        "src_block": F.col("_metadata.file_block_start"),
        "source_year": year_in_path(F.col("_metadata.file_path")),
    })


def manifest_path(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/landing_manifest.parquet"


def row_year() -> Column:
    """The year a raw row belongs to: of its date, else of its file; null if neither tells."""
    return F.coalesce(F.year(parse_obs_date(F.col("date"))), F.col("source_year"))


def note_files(batch: DataFrame, out_root: str, epoch_id: int) -> None:
    """The manifest's part of a batch: (file, year, rows), a row per file and year; a replay overwrites it."""
    batch.groupBy(F.col("src_file").alias("file"), row_year().alias("year")).agg(F.count(F.lit(1)).alias("rows")).write.mode(
        "overwrite").option("partitionOverwriteMode", "static").parquet(f"{manifest_path(out_root)}/batch={epoch_id}")


def rows_of_years(spark: SparkSession, out_root: str, years: list[int], epoch_id: int) -> DataFrame | None:
    """The landed rows of ``years``, and the batch's own rows of no year, from the files that hold them alone.

    The manifest gives these files; their list is as long as any scan of them keeps on the driver."""
    schema = "file string, year int, rows bigint, batch bigint"
    noted = spark.read.schema(schema).parquet(manifest_path(out_root))
    undated = F.col("year").isNull() & (F.col("batch") == epoch_id)
    held = noted.filter(F.col("year").isin(years) | undated).groupBy("file").agg(F.bool_or(undated).alias("undated")).collect()
    if not held:
        return None
    files = sorted(unquote(r.file) for r in held)  # as the metadata names them
    rows = with_source_year(read_observations(spark, files, with_position=True))
    own = F.col("src_file").isin([r.file for r in held if r.undated])
    return rows.filter(row_year().isin(years) | (row_year().isNull() & own))


def start_incremental_ingest(
    spark: SparkSession, landing_dir: str, out_root: str, checkpoint: str | None = None,
    country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS,
    max_files_per_trigger: int | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present now.

    The checkpoint goes to the shared checkpoint location unless given.
    """
    def _batch(batch: DataFrame, epoch_id: int) -> None:
        # in the batch's own session; years come from valid dates and file names alone
        session = batch.sparkSession
        note_files(batch, out_root, epoch_id)
        years = jobs.touched_years(prepare_observations(batch.withColumn("__file_year", F.col("source_year")), country, elements))
        rows = rows_of_years(session, out_root, years, epoch_id)
        if rows is not None:
            jobs.ingest(rows, out_root, years=years, country=country, elements=elements, undated_key=f"batch-{epoch_id}")

    if not checkpoint and not spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("a stream needs a checkpoint folder of its own that outlives the run")
    w = (
        observation_stream(spark, landing_dir, max_files_per_trigger)
        .writeStream.foreachBatch(_batch)
        .option("checkpointLocation", checkpoint or scratch_dir(spark, "ingest-stream-checkpoint"))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
