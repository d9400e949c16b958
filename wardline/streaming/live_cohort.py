"""The index cohort kept up to date while its tables arrive in parts, in any order.

An event that arrives late can move a patient's index date to an earlier day, and with it change which
exclusions count; a late patient row or encounter changes attributes and history. So the state holds
what the batch plan aggregates first, and each part only adds to it:

    days/batch=<n>      coded events per (patient, day) of a part of the conditions
    seen/batch=<n>      first encounter per patient of a part of the encounters
    people/batch=<n>    patient rows of a part, equal ones collapsed to a count
    cohort/seq=<k>      cohort rows of the patients that step k touched
    touched/seq=<k>     those patients, and the part it was: written last, it completes the step

All these merge (sums, least rows, counts), so a patient's state is the same whatever the order and
the cut of the parts. A step recomputes the rows of the patients it touched, from all that is known of
them, and nobody else's; of a patient the rows of the latest step count. A part that is given again
replaces itself: a step that died half-way is repeated, and counts once.

The state's size is that of merged days, not of events, however many parts. `compact` merges the parts.
A null patient is a patient, as in the batch cohort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import cohort as cohorts
from ..sources import files
from ..sources.layers import materialize
from ..spec import StudySpec

SOURCES = {"conditions": "days", "encounters": "seen", "patients": "people"}
DAYS = (
    "patient_id string, condition_start_date date, target_rows bigint, prior_rows bigint, window_rows bigint,"
    " first_row struct<encounter_id:string,description:string,code:string>"
)
SEEN = "patient_id string, first_observed_date date"
PEOPLE = (
    "patient_id string, birth_date date, death_date date, sex string, race string, ethnicity string, copies bigint"
)
SCHEMAS = {"days": DAYS, "seen": SEEN, "people": PEOPLE}


class LiveCohort:
    """State of one study in a folder. Parts of one table are numbered by the caller, as a stream does."""

    def __init__(self, spark: SparkSession, folder: str, spec: StudySpec):
        self.spark, self.folder, self.spec = spark, folder.rstrip("/"), spec

    # --- adding parts ------------------------------------------------------------------------

    def add(self, table: str, part: DataFrame, batch: int) -> None:
        """Add part number `batch` of "conditions", "encounters" or "patients"."""
        kind = SOURCES[table]
        if kind == "days":
            merged = cohorts.coded_days(part, self.spec)
        elif kind == "seen":
            merged = cohorts.first_observed(part)
        else:
            merged = cohorts.patient_copies(part)
        self._write(merged, SCHEMAS[kind], f"{kind}/batch={batch}")
        added = self.spark.read.schema(SCHEMAS[kind]).parquet(f"{self.folder}/{kind}/batch={batch}")
        step, touched = self._step(table, batch), added.select("patient_id").distinct()
        self._write(self._rows_of(touched), None, f"cohort/seq={step}")
        stamped = touched.select("patient_id", F.lit(table).alias("table"), F.lit(batch).cast("bigint").alias("batch"))
        self._write(stamped, None, f"touched/seq={step}")

    def _write(self, frame: DataFrame, schema: str | None, name: str) -> None:
        if schema:
            fields = StructType.fromDDL(schema)
            frame = frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        frame.write.mode("overwrite").parquet(f"{self.folder}/{name}")

    def _step(self, table: str, batch: int) -> int:
        """A new step's number, one past the last completed."""
        steps = [int(n.split("=")[1]) for n in files.list_directory(f"{self.folder}/touched", "") if n.startswith("seq=")]
        return max(steps, default=0) + 1

    def _state(self, kind: str) -> DataFrame:
        path = f"{self.folder}/{kind}"
        if not files.path_exists(path):
            return self.spark.createDataFrame([], SCHEMAS[kind])
        # Parts are folders, whose number is no column here.
        return self.spark.read.schema(SCHEMAS[kind]).option("recursiveFileLookup", True).parquet(path)

    def _rows_of(self, touched: DataFrame) -> DataFrame:
        """Cohort rows of some patients, from all parts. Few patients are broadcast to the state."""
        known = materialize(touched, "touched")
        ids = F.broadcast(known) if cohorts.fits_broadcast(known) else known
        ids = ids.withColumnRenamed("patient_id", "known_id")
        days, seen, people = (
            frame.join(ids, frame["patient_id"].eqNullSafe(ids["known_id"]), "left_semi")
            for frame in map(self._state, ("days", "seen", "people"))
        )
        seen = seen.groupBy("patient_id").agg(F.min("first_observed_date").alias("first_observed_date"))
        people = people.groupBy(*cohorts.PATIENT_COLUMNS).agg(F.sum("copies").alias("copies"))
        index = cohorts.index_from_days(cohorts.merged_days(days))
        blocks = cohorts.cohort_blocks(index, people, seen, self.spec)
        return blocks.select(*cohorts.COHORT_COLUMNS, "copies_in_block")

    # --- reading -----------------------------------------------------------------------------

    def current(self) -> DataFrame:
        """The index cohort of all parts added so far."""
        return cohorts.multiply_copies(self._current_blocks())

    def _current_blocks(self) -> DataFrame:
        touched = self.spark.read.parquet(f"{self.folder}/touched")
        rows = self.spark.read.option("basePath", f"{self.folder}/cohort").parquet(f"{self.folder}/cohort")
        latest = touched.groupBy(F.col("patient_id").alias("known_id")).agg(F.max("seq").alias("latest"))
        same = rows["patient_id"].eqNullSafe(latest["known_id"]) & (rows["seq"] == latest["latest"])
        return rows.join(latest, same).drop("seq", "known_id", "latest")

    def history(self) -> DataFrame:
        """(seq, table, batch, patients): the steps taken, with the patients that each touched."""
        touched = self.spark.read.parquet(f"{self.folder}/touched")
        return touched.groupBy("seq", "table", "batch").agg(F.count(F.lit(1)).alias("patients"))

    def compact(self, folder: str) -> LiveCohort:
        """The same state in a new folder, all parts merged to one; parts added there are numbered from
        1 on. The old folder stays as it is."""
        new = LiveCohort(self.spark, folder, self.spec)
        new._write(cohorts.merged_days(self._state("days")), DAYS, "days/batch=0")
        seen = self._state("seen").groupBy("patient_id").agg(F.min("first_observed_date").alias("first_observed_date"))
        new._write(seen, SEEN, "seen/batch=0")
        people = self._state("people").groupBy(*cohorts.PATIENT_COLUMNS).agg(F.sum("copies").alias("copies"))
        new._write(people, PEOPLE, "people/batch=0")
        new._write(self._current_blocks(), None, "cohort/seq=0")
        touched = self.spark.read.parquet(f"{self.folder}/touched").select("patient_id").distinct()
        stamp = [F.lit("all").alias("table"), F.lit(0).cast("bigint").alias("batch")]
        new._write(touched.select("patient_id", *stamp), None, "touched/seq=0")
        return new

    # --- streams -----------------------------------------------------------------------------

    def follow(self, silver_dir: str, checkpoint_dir: str, files_per_batch: int = 1000) -> None:
        """Add the part files of the three silver tables that earlier calls have not seen, then return.
        The checkpoints remember finished files; a batch that died is repeated under its number."""
        for table in SOURCES:
            path = f"{silver_dir.rstrip('/')}/{table}.parquet"
            if not files.path_exists(path):
                continue
            parts = (
                self.spark.readStream.schema(self.spark.read.parquet(path).schema)
                .option("maxFilesPerTrigger", files_per_batch)
                .parquet(path)
            )
            query = (
                parts.writeStream.foreachBatch(self._adder(table))
                .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{table}")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()

    def _adder(self, table: str):
        def add(part: DataFrame, number: int) -> None:
            # The batch's own session has the stream's settings; its frame is read with it.
            LiveCohort(part.sparkSession, self.folder, self.spec).add(table, part, number + 1)

        return add
