"""Declared schemas of the raw extracts. Nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RawTable:
    file: str
    schema: T.StructType
    minimum_rows: int
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    required_severity: str = "error"
    partition_by: tuple[str, ...] = ()


KEY, WHOLE, TEXT = T.LongType(), T.IntegerType(), T.StringType()
NUMBER, TIME = T.DoubleType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- Fixed values: the layout of the raw extracts. ---
TABLES: dict[str, RawTable] = {
    "patients": RawTable(
        "patients.csv",
        _schema(
            subject_id=KEY, gender=TEXT, anchor_age=WHOLE, anchor_year=WHOLE,
            anchor_year_group=TEXT, dod=TIME,
        ),
        10, required=("subject_id",),
    ),
    "admissions": RawTable(
        "admissions.csv",
        _schema(
            subject_id=KEY, hadm_id=KEY, admittime=TIME, dischtime=TIME,
            deathtime=TIME, admission_type=TEXT, admit_provider_id=TEXT,
            admission_location=TEXT, discharge_location=TEXT, insurance=TEXT,
            language=TEXT, marital_status=TEXT, race=TEXT, edregtime=TIME,
            edouttime=TIME, hospital_expire_flag=WHOLE,
        ),
        10, required=("subject_id", "hadm_id"),
    ),
    "diagnoses_icd": RawTable(
        "diagnoses_icd.csv",
        _schema(
            subject_id=KEY, hadm_id=KEY, seq_num=WHOLE, icd_code=TEXT,
            icd_version=WHOLE,
        ),
        10, required=("subject_id",),
    ),
    "d_labitems": RawTable(
        "d_labitems.csv",
        _schema(
            itemid=KEY, label=TEXT, fluid=TEXT, category=TEXT,
        ),
        5, required=("itemid",), unique=("itemid",),
    ),
    "labevents": RawTable(
        "labevents.csv",
        _schema(
            labevent_id=KEY, subject_id=KEY, hadm_id=KEY, specimen_id=KEY,
            itemid=KEY, order_provider_id=TEXT, charttime=TIME, storetime=TIME,
            value=TEXT, valuenum=NUMBER, valueuom=TEXT, ref_range_lower=NUMBER,
            ref_range_upper=NUMBER, flag=TEXT, priority=TEXT, comments=TEXT,
        ),
        10, required=("subject_id", "itemid"), required_severity="warn",
    ),
    "chartevents": RawTable(
        "chartevents.csv",
        _schema(
            subject_id=KEY, hadm_id=KEY, stay_id=KEY, caregiver_id=KEY,
            charttime=TIME, storetime=TIME, itemid=KEY, value=TEXT,
            valuenum=NUMBER, valueuom=TEXT, warning=WHOLE,
        ),
        0,
    ),
    "ecg_record_list": RawTable(
        "record_list.csv",
        _schema(
            subject_id=KEY, study_id=KEY, file_name=TEXT, ecg_time=TIME,
            path=TEXT,
        ),
        0, required=("subject_id", "study_id"),
    ),
}
