import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("wardline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return date.fromisoformat(text) if text else None


PATIENTS = "patient_id string, birth_date date, death_date date, sex string, race string, ethnicity string"
CONDITIONS = (
    "patient_id string, encounter_id string, condition_start_date date, code string,"
    " description string"
)
ENCOUNTERS = "patient_id string, encounter_start_date date"


class Clinic:
    """Small typed tables for cohort tests."""

    def __init__(self, spark):
        self.spark = spark

    def patients(self, *rows):
        """(patient_id, birth_date, ...)"""
        full = [
            (r[0], day(r[1]), day(r[2]) if len(r) > 2 else None, "F", "white", "nonhispanic")
            for r in rows
        ]
        return self.spark.createDataFrame(full, PATIENTS)

    def conditions(self, *rows):
        """(patient_id, encounter_id, date, code, description)"""
        full = [(r[0], r[1], day(r[2]), r[3], r[4] if len(r) > 4 else "text") for r in rows]
        return self.spark.createDataFrame(full, CONDITIONS)

    def encounters(self, *rows):
        return self.spark.createDataFrame([(p, day(d)) for p, d in rows], ENCOUNTERS)


@pytest.fixture(scope="session")
def clinic(spark):
    return Clinic(spark)
