"""Feature rows that change with the clock alone, kept by the day they fall due.

Health, due and warranty bands of a piece stay as they are until one of a few
instants that follow from its dates.  Each stored row carries the next of them and
lies in the folder of its day, or of its month while that is some weeks ahead, so a
daily run reads the folders that have come due and those of changed pieces, and
nothing else.  A month that has come is dealt to its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetops.clock import Clock
from assetops.functions import domain
from assetops.functions.temporal import plus_days
from assetops.operators.facts import with_health
from assetops.schema import SCHEMAS
from assetops.sources.versioned import VersionedTable

DATES = ("NextMaintenanceDate", "WarrantyExpiry", "PurchaseDate")
BANDS = ("Health_Units", "Maintenance_Status", "Warranty_Status", "Warranty_Window")
NEVER = "never"
DAYS_AHEAD = 31  # rows that flip later lie in the folder of a month
#: Ages in hundredths of a year at which the health score steps.
AGE_STEPS = (500, 1000)


def days_of_age(units: int) -> int:
    """Whole days from which a piece's age, rounded, is ``units`` hundredths of a year."""
    return -(-(units * 2 * 36525 - 36525) // 20000)


def features(pieces: DataFrame, clock: Clock) -> DataFrame:
    """(EquipmentID, dates, bands) of every piece as of the clock."""
    due, expiry = F.col("NextMaintenanceDate"), F.col("WarrantyExpiry")
    return with_health(pieces, clock).select(
        "EquipmentID",
        *DATES,
        F.col("health_units").alias("Health_Units"),
        domain.due_status(due, clock).alias("Maintenance_Status"),
        domain.warranty_status(expiry, clock).alias("Warranty_Status"),
        domain.warranty_window(expiry, clock).alias("Warranty_Window"),
    )


def next_flip(clock: Clock) -> Column:
    """The first instant after the clock's at which a band of the piece differs;
    NULL if there is none.  What ends with an instant flips just after it."""
    due, expiry, bought = (F.col(c) for c in DATES)
    after = F.expr("interval 1 microsecond")
    flips = [due + after, plus_days(due, -7), plus_days(due, -30), expiry + after, plus_days(expiry, -30), plus_days(expiry, -90)]
    flips += [plus_days(bought, days_of_age(step)) for step in AGE_STEPS]
    return F.array_min(F.filter(F.array(*flips), lambda x: x > clock.now))


class DueFeatures:
    def __init__(self, spark: SparkSession, path: str):
        own = [SCHEMAS["equipment"][c] for c in ("EquipmentID", *DATES)]
        bands = [T.StructField(BANDS[0], T.LongType()), *(T.StructField(c, T.StringType()) for c in BANDS[1:])]
        schema = T.StructType([*own, *bands, T.StructField("flips_at", T.TimestampNTZType()), T.StructField("folder", T.StringType())])
        self.table = VersionedTable(spark, path, schema, F.col("folder"), ("EquipmentID",))

    def _rows(self, pieces: DataFrame, clock: Clock) -> DataFrame:
        at = F.col("flips_at")
        day, month = (F.date_format(at, form) for form in ("yyyy-MM-dd", "yyyy-MM"))
        folder = F.when(at.isNull(), NEVER).when(at < clock.in_days(DAYS_AHEAD), day).otherwise(month)
        return features(pieces, clock).withColumn("flips_at", next_flip(clock)).withColumn("folder", folder)

    def start(self, pieces: DataFrame, clock: Clock) -> None:
        self.table.write(self._rows(pieces, clock))

    def due(self, clock: Clock) -> list[str]:
        """The folders that hold a row that may have flipped by now."""
        today = clock.as_of.strftime("%Y-%m-%d")  # a month sorts before its days
        return [day for day in self.table.parts() if day != NEVER and day <= today]

    def run(self, clock: Clock, last: Clock, changes: DataFrame | None = None) -> list[str]:
        """Brings the rows from ``last`` to ``clock`` and takes in changed pieces
        (old, new: images with the id and the dates).  Returns the folders read: a
        changed piece's old row lies where its old dates flip after ``last``, in the
        folder of that day or still in that of its month."""
        days = set(self.due(clock))
        images = ids = None
        if changes is not None:
            old = changes.where("old is not null").select("old.*")
            # As many rows as there are days.
            flips = F.date_format(next_flip(last), "yyyy-MM-dd")
            found = {r.day or NEVER for r in old.select(flips.alias("day")).distinct().collect()}
            days |= found | {day[:7] for day in found if day != NEVER}
            images = changes.where("new is not null").select("new.EquipmentID", *(f"new.{c}" for c in DATES))
            ids = changes.select(F.coalesce("new.EquipmentID", "old.EquipmentID").alias("EquipmentID")).distinct()

        def rows(entry: dict) -> DataFrame:
            kept = self.table.read(entry, days).select("EquipmentID", *DATES)
            if images is not None:
                kept = kept.join(ids, "EquipmentID", "left_anti").unionByName(images)
            return self._rows(kept, clock)

        self.table.replace(rows, days, within=False)
        return sorted(days)

    def load(self) -> DataFrame:
        return self.table.load().select("EquipmentID", *BANDS)
