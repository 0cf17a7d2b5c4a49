"""Sources and sinks. Round trips write whole tables to the shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import rounded
from cohortloom.operators import shred
from cohortloom.plans.jobs import bronze_ingest
from cohortloom.session import fresh_path
from cohortloom.sources import lake, manifest, quarantine, snapshot
from cohortloom.sources.schemas import TABLES

ADMISSION_FILE_COLUMNS = (
    "subject_id", "hadm_id", "admittime", "dischtime", "admission_type", "hospital_expire_flag",
)
FIRST_ADMISSIONS = f"""
select {', '.join(ADMISSION_FILE_COLUMNS)} from first_admissions"""


def as_raw_file(df, table: str):
    """The frame in a raw file's layout, absent columns empty, times as text."""
    known = dict(df.dtypes)
    out = []
    for field in TABLES[table].schema.fields:
        kind = known.get(field.name)
        if kind is None:
            column = F.lit(None).cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(F.col(field.name), lake.RAW_TIMESTAMP_FORMAT)
        else:
            column = F.col(field.name).cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def write_raw(df, folder: str, table: str) -> None:
    as_raw_file(df, table).write.csv(f"{folder}/{TABLES[table].file}", header=True, escape='"')


def _first_admissions(t):
    """Orders in the admission layout, without the second copy."""
    doubled = t.raw_admissions
    return doubled.groupBy("hadm_id").agg(*[
        F.min(c).alias(c) for c in doubled.columns if c != "hadm_id"
    ])


@query("s1_read_csv", FIRST_ADMISSIONS)
def s1(t):
    folder = fresh_path(t.spark, "csv")
    write_raw(_first_admissions(t), folder, "admissions")
    path = f"{folder}/{TABLES['admissions'].file}"
    return lake.read_csv(t.spark, path, TABLES["admissions"].schema).select(
        *ADMISSION_FILE_COLUMNS
    )


def spoiled(t):
    """The admissions file with cells that do not parse in some rows."""
    key = F.col("hadm_id")
    rows = as_raw_file(_first_admissions(t), "admissions")
    return rows.withColumns({
        "subject_id": F.when(key % 13 == 0, F.concat(F.lit("S"), "subject_id")).otherwise(F.col("subject_id")),
        "admittime": F.when(key % 17 == 0, F.lit("yesterday")).otherwise(F.col("admittime")),
        "hospital_expire_flag": F.when(key % 19 == 0, F.lit("1.5")).otherwise(
            F.col("hospital_expire_flag")),
    })


def checked_admissions(t):
    path = f"{fresh_path(t.spark, 'csv')}/{TABLES['admissions'].file}"
    spoiled(t).write.csv(path, header=True, escape='"')
    return quarantine.read_checked(t.spark, path, TABLES["admissions"].schema)


@query("s1_quarantine_reasons", """
select 'subject_id' as "column", 'bigint' as kind, count(*) as cells
  from first_admissions where hadm_id % 13 = 0 having count(*) > 0
union all select 'admittime', 'timestamp', count(*) from first_admissions where hadm_id % 17 = 0 having count(*) > 0
union all select 'hospital_expire_flag', 'int', count(*) from first_admissions where hadm_id % 19 = 0
  having count(*) > 0""")
def s1_reasons(t):
    """Bad cells by column and kind, from a file with spoiled cells."""
    return quarantine.reason_counts(quarantine.split_checked(checked_admissions(t), "checked")[1])


@query("s1_quarantine_good_rows", f"""{FIRST_ADMISSIONS}
where hadm_id % 13 <> 0 and hadm_id % 17 <> 0 and hadm_id % 19 <> 0""")
def s1_good(t):
    """The rows of the same file without a bad cell, as the plain reader gives them."""
    good = quarantine.split_checked(checked_admissions(t), "checked")[0]
    return good.select(*ADMISSION_FILE_COLUMNS)


@query("s2_read_raw", """
select itemid, trim(label) as label, fluid, category from (
  select p_partkey as itemid, '  ' || p_name || ' ' as label, p_brand as fluid,
    p_type as category from part)""")
def s2(t):
    folder = fresh_path(t.spark, "raw")
    write_raw(t.items, folder, "d_labitems")
    return lake.read_raw(t.spark, folder, "d_labitems").withColumn("label", F.trim("label"))


@query("s3_write_parquet", """
select split, n_rows from (
  select o_orderstatus as split, count(*) as n_rows from orders group by 1)""")
def s3(t):
    path = fresh_path(t.spark, "parquet")
    lake.write_parquet(t.load("orders"), path, partition_by=["o_orderstatus"], repartition=4)
    back = t.spark.read.parquet(path)
    return back.groupBy(F.col("o_orderstatus").alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("s4_read_layer", """
select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000""")
def s4(t):
    """A pruned, filtered scan of a layer: two columns and both predicates reach Parquet."""
    home = lake.Lake(fresh_path(t.spark, "lake"))
    lake.write_layer(t.load("orders"), home, "bronze", "orders")
    orders = lake.read_layer(t.spark, home, "bronze", "orders")
    return orders.where("o_orderstatus = 'F' and o_totalprice > 100000").select(
        "o_orderkey", "o_totalprice"
    )


@query("s5_write_layer", """
select p_partkey, p_name, 'run-7' as _run_id, 'silver.parts' as _source, true as loaded
from part""")
def s5(t):
    home = lake.Lake(fresh_path(t.spark, "lake"))
    lake.write_layer(t.load("part"), home, "silver", "parts", run_id="run-7")
    return lake.read_layer(t.spark, home, "silver", "parts").select(
        "p_partkey", "p_name", "_run_id", "_source",
        F.col("_loaded_at").isNotNull().alias("loaded"),
    )


@query("s6_with_lineage", """
select c_custkey, 'run-1' as _run_id, 'bronze.customer' as _source, true as loaded from customer""")
def s6(t):
    stamped = lake.with_lineage(t.load("customer"), "bronze.customer", "run-1")
    return stamped.select("c_custkey", "_run_id", "_source",
                          F.col("_loaded_at").isNotNull().alias("loaded"))


@query("s7_drop_lineage", "select *, 'run-1' as _run_id from customer")
def s7(t):
    stamped = lake.with_lineage(t.load("customer"), "bronze.customer", "run-1")
    return lake.drop_lineage(stamped, ["_run_id"])


@query("s9_append_history", """
select * from (select distinct on (run_id, layer, table_name, check_name) * from dq_results)""")
def s9(t):
    """The older runs, then all, then all again: every result stands there once."""
    path, keys = fresh_path(t.spark, "history"), ["run_id", "layer", "table_name", "check_name"]
    ready = lake.materialise(t.dq_results, "history-source")
    for results in (ready.where("run_id <> 'run-4'"), ready, ready):
        lake.append_history(results, path, keys)
    return t.spark.read.parquet(path)


@query("s10_replace_run", """
select run_id, count(*) as n_rows, max(metric_name) as last_metric from (
  select * from model_metrics where run_id <> 'run-3'
  union all select * replace ('again' as metric_name) from model_metrics where run_id = 'run-3')
group by run_id""")
def s10(t):
    path = fresh_path(t.spark, "metrics")
    ready = lake.materialise(t.model_metrics, "metrics-source")
    for row in ready.select("run_id").distinct().collect():
        lake.replace_run(ready, path, row.run_id)
    redone = ready.where("run_id = 'run-3'").withColumn("metric_name", F.lit("again"))
    lake.replace_run(redone, path, "run-3")
    return lake.read_runs(t.spark, path, ready.schema).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("metric_name").alias("last_metric")
    )


@query("s11_export_flat", "select * from orders")
def s11_flat(t):
    path = fresh_path(t.spark, "export")
    orders = t.load("orders")
    lake.export_flat(orders, path, "csv")
    return lake.read_export(t.spark, path, orders.schema)


@query("s11_export_summary", f"""
select coalesce(split, 'all') as split, count(*) as n_rows,
  {rounded('avg(label)', 6)} as label_mean
from cohort group by grouping sets ((split), ())""")
def s11(t):
    return lake.export_summary(t.cohort)


@query("s12_file_manifest", """
select distinct stem || ending as file
from (select distinct path, replace(replace(path, '.hea', ''), '.dat', '') as stem
  from user_points where path is not null),
  (values ('.hea'), ('.dat')) as e(ending)""")
def s12(t):
    return manifest.file_manifest(t.user_points)


@query("s13_harmonise_columns", """
select user_id as subject_id, event_id as study_id, 'rec' || event_id as path, ts as ecg_time
from events where event_type = 'click'""")
def s13(t):
    raw = t.user_points.select(
        F.col("subject_id").alias(" Subject_No "), F.col("study_id").alias("STUDY"),
        F.col("file_name").alias("FileName"), F.col("ecg_time").alias("ECG_Time_Start"),
    )
    return manifest.harmonise_columns(raw)


@query("s14_bronze_ingest", """
select 'admissions' as table_name, count(*) as n_rows from orders
union all select 'd_labitems', count(*) from part
union all select 'labevents', count(*) from lineitem
union all select 'patients', count(*) from raw_patients""")
def s14(t):
    """Raw files through the ingestion job; absent files are skipped."""
    source, home = fresh_path(t.spark, "raw"), lake.Lake(fresh_path(t.spark, "lake"))
    write_raw(t.raw_patients, source, "patients")
    write_raw(_first_admissions(t), source, "admissions")
    write_raw(t.items, source, "d_labitems")
    labs = t.raw_labs.withColumn("subject_id", F.col("hadm_id"))
    write_raw(labs, source, "labevents")
    counts = bronze_ingest(t.spark, source, home, skip_missing=True)
    return lake.row_counts(**{
        name: lake.read_layer(t.spark, home, "bronze", name) for name in counts
    })


def event_history(t) -> DataFrame:
    """Events as records of three deliveries: most first, late ones and corrections second,
    outdated copies and withdrawals third."""
    key = F.col("event_id")
    events = t.load("events").select("event_id", "user_id", "event_type", "value", "ts")
    first = events.where(key % 5 != 0).withColumns({"delivery": F.lit(1), "revision": F.lit(1)})
    late = events.where(key % 5 == 0).withColumns({"delivery": F.lit(2), "revision": F.lit(1)})
    mended = events.where(key % 7 == 0).withColumns({
        "delivery": F.lit(2), "revision": F.lit(2), "value": F.col("value") + 1})
    outdated = events.where(key % 11 == 0).withColumns({
        "delivery": F.lit(3), "revision": F.lit(0), "value": F.lit(-1.0)})
    withdrawn = events.where(key % 97 == 0).withColumns({
        "delivery": F.lit(3), "revision": F.lit(3)})
    parts = (first, late, mended, outdated, withdrawn)
    return reduce(DataFrame.unionByName, parts).withColumn("withdrawn", F.col("revision") == 3)


@query("s17_snapshot_upsert", """
select event_id, user_id, event_type, value + (event_id % 7 = 0)::int as value, ts,
  case when event_id % 7 = 0 then 2 else 1 end as revision
from events where event_id % 97 <> 0""")
def s17(t):
    """Late, corrected, outdated and withdrawn records, merged delivery by delivery."""
    history = lake.materialise(event_history(t), "history-source")
    kept = T.StructType([f for f in history.schema if f.name not in ("delivery", "withdrawn")])
    table = snapshot.SnapshotTable.create(
        t.spark, fresh_path(t.spark, "snapshot"), kept, ["event_id"], ["revision"], buckets=16)
    for delivery in (1, 2, 3):
        table.upsert(history.where(F.col("delivery") == delivery), deleted="withdrawn")
    return table.read()


def rich_properties(t) -> DataFrame:
    """Events with more in their JSON: a name, numbers, a key of mixed kinds, an object; some
    texts are cut off."""
    key = F.col("event_id")
    mixed = F.when(key % 2 == 0, F.lit('"even"')).otherwise((key % 3).cast("string"))
    text = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "kind": "'), F.col("event_type"),
        F.lit('", "seven": '), F.when(key % 7 > 0, (key % 7).cast("string")).otherwise(F.lit("null")),
        F.lit(', "mixed": '), mixed, F.lit(', "where": {"user": '), F.col("user_id").cast("string"), F.lit("}}"))
    return t.load("events").select("event_id", F.when(key % 211 == 0, F.lit("{cut")).otherwise(text).alias("props"))


@query("s18_shredded_properties", """
select event_id, case when event_id % 211 <> 0 then (props->>'k')::bigint end as k,
  case when event_id % 211 <> 0 then event_type end as kind,
  case when event_id % 211 <> 0 and event_id % 7 > 0 then event_id % 7 end as seven,
  case when event_id % 211 <> 0 then '{' || case when event_id % 7 = 0 then '"seven":null,' else '' end
    || '"mixed":' || case when event_id % 2 = 0 then '"even"' else (event_id % 3)::varchar end
    || ',"where":{"user":' || user_id || '}}' end as rest,
  case when event_id % 211 = 0 then '{cut' end as malformed
from events""")
def s18(t):
    """Columns for the keys of one kind, found in the data; all else in the rest."""
    events = rich_properties(t)
    return shred.shred(events, "props", shred.discover(events, "props"))


@query("s15_row_counts", """
select 'orders' as table_name, count(*) as n_rows from orders
union all select 'lineitem', count(*) from lineitem
union all select 'customer', count(*) from customer""")
def s15(t):
    return lake.row_counts(**{n: t.load(n) for n in ("orders", "lineitem", "customer")})


@query("s16_read_optional", """
select c_custkey, true as parts_found, false as points_found from customer""")
def s16(t):
    home = lake.Lake(fresh_path(t.spark, "lake"))
    lake.write_layer(t.load("part"), home, "silver", "parts")
    parts = lake.read_optional(t.spark, home, "silver", "parts")
    points = lake.read_optional(t.spark, home, "silver", "points")
    return t.load("customer").select(
        "c_custkey", F.lit(parts is not None).alias("parts_found"),
        F.lit(points is not None).alias("points_found"),
    )
