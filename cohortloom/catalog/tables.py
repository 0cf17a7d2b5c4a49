"""The given tables in the roles the operators need.

``orders`` view: customers are subjects, orders are stays, line items are
measurements and, with their part, diagnoses; parts are the item dictionary.

``activity`` view: users are subjects, a sign-up opens a stay that lasts until
the next one, all other events are measurements.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import elapsed_hours, hash_bucket, hash_ordinal, time_slice
from cohortloom.operators import cleaning, cohort, features
from cohortloom.operators.joins import DAY, interval_join
from cohortloom.operators.metrics import evaluate
from cohortloom.operators.quality import Suite
from cohortloom.plans import warehouse
from cohortloom.rules import RULES
from cohortloom.sources.lake import materialise, with_lineage

ORDER_RULES = replace(
    RULES, case_prefixes=("BRAND#25ECONOMY",), exclusion_prefixes=("BRAND#25",),
    target_patterns=("ring", "bolt", "gear", "anvil"), acute_patterns=("ring",),
)
ACTIVITY_RULES = replace(
    RULES, case_prefixes=("PURCHASE1",), exclusion_prefixes=("PURCHASE1", "PURCHASE2"),
)
SEGMENT_TEXT = {"BUILDING": "m", "MACHINERY": "MALE", "AUTOMOBILE": " f ",
                "HOUSEHOLD": "Female", "FURNITURE": "X"}
ITEM_NUMBERS = {"click": 1, "error": 2, "purchase": 3, "view": 4}
ACUTE_EVENTS = ("error", "purchase")
LOADED_AT = "timestamp_ntz'2024-02-01 00:00:00'"
MODELS = ("tabular", "combined")
#: Orders up to which their join may be a broadcast, and lines that one task takes beyond.
FEW_ORDERS = 2_000_000
TASK_LINES = 200_000


def days(number: Column) -> Column:
    return F.make_dt_interval(days=number.cast("int"))


def next_in_key(df: DataFrame, by: str, at: str, ties: str, out: str) -> DataFrame:
    """The next ``at`` of the same key, day by day so that a busy key is spread.

    The last row of a day takes the first moment of the key's next busy day; at
    most one row per key and day takes part in that step.
    """
    sliced = df.withColumn("_slice", time_slice(at, DAY))
    firsts = sliced.groupBy(by, "_slice").agg(F.min(at).alias("_first"))
    carried = firsts.select(
        by, "_slice",
        F.lead("_first").over(Window.partitionBy(by).orderBy("_slice")).alias("_carry"),
    )
    within = Window.partitionBy(by, "_slice").orderBy(at, ties)
    return sliced.join(carried, [by, "_slice"]).withColumn(
        out, F.coalesce(F.lead(at).over(within), "_carry")
    ).drop("_slice", "_carry")


@dataclass
class Tables:
    """Raw and derived tables. The ``*_plan`` members are lazy; their namesakes
    are written once to the shared folder, as the layer jobs do, so that what
    builds on them starts from a table instead of repeating the plan."""

    spark: SparkSession
    folder: str

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- orders view: raw -----------------------------------------------------

    @cached_property
    def raw_patients(self) -> DataFrame:
        """Customers, and a second record of each, a year later."""
        text = F.create_map(*[F.lit(x) for pair in SEGMENT_TEXT.items() for x in pair])
        nation = F.col("c_nationkey")
        first = self.load("customer").select(
            F.col("c_custkey").alias("subject_id"),
            F.try_element_at(text, F.col("c_mktsegment")).alias("gender"),
            F.floor(F.col("c_acctbal") / 100).cast("int").alias("anchor_age"),
            (F.lit(2100) + nation).alias("anchor_year"),
            F.concat(F.lit("group "), (nation % 5).cast("string")).alias("anchor_year_group"),
            F.when(F.col("c_acctbal") < 0,
                   F.expr("timestamp_ntz'2110-01-01 00:00:00'") + days(nation)).alias("dod"),
        )
        again = first.withColumns({"gender": F.lit("MALE"),
                                   "anchor_year": F.col("anchor_year") + 1})
        return first.unionByName(again)

    @cached_property
    def raw_admissions(self) -> DataFrame:
        """Orders, and a late duplicate of each."""
        key, start = F.col("o_orderkey"), F.col("o_orderdate")
        end = (
            F.when(F.col("o_orderstatus") == "O", F.lit(None))
            .when(key % 50 == 0, start - F.make_dt_interval(hours=F.lit(5)))
            .otherwise(start + days(1 + key % 180))
        )
        first = self.load("orders").select(
            F.col("o_custkey").alias("subject_id"), key.alias("hadm_id"),
            start.alias("admittime"), end.alias("dischtime"),
            F.col("o_orderpriority").alias("admission_type"),
            F.concat(F.lit("WARD "), (key % 7).cast("string")).alias("admission_location"),
            F.col("o_orderstatus").alias("discharge_location"),
            F.col("o_orderstatus").alias("insurance"),
            F.substring("o_orderpriority", 1, 1).alias("marital_status"),
            F.substr(F.col("o_orderpriority"), F.lit(3)).alias("race"),
            F.when(key % 25 == 0, F.lit(1)).alias("hospital_expire_flag"),
        )
        shift = days(F.lit(1))
        again = first.withColumns({"admittime": F.col("admittime") + shift,
                                   "dischtime": F.col("dischtime") + shift})
        return first.unionByName(again)

    @cached_property
    def raw_diagnoses(self) -> DataFrame:
        return self.coded_lines()

    def coded_lines(self, tasks: int | None = None) -> DataFrame:
        """Lines with their part and order; the order is joined in so many tasks."""
        number = F.col("l_linenumber")
        lines = self.load("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
        parts = self.load("part").select("p_partkey", "p_brand", "p_type")
        orders = self.load("orders").select("o_orderkey", "o_custkey")
        coded = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        if tasks:
            coded = coded.repartition(tasks, "l_orderkey")
            orders = orders.repartition(tasks, "o_orderkey")
        return coded.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
            number.alias("seq_num"),
            F.concat(F.lit(" "), "p_brand", F.lit("."), "p_type", F.lit(" ")).alias("icd_code"),
            F.when(number == 7, 9).when(number != 3, 10).alias("icd_version"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.load("part").select(
            F.col("p_partkey").alias("itemid"),
            F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("label"),
            F.col("p_brand").alias("fluid"), F.col("p_type").alias("category"),
        )

    @cached_property
    def raw_dictionary(self) -> DataFrame:
        """Parts, and a second entry of each under another label."""
        again = self.items.withColumn("label", F.concat(F.lit("zz "), F.trim("label")))
        return self.items.unionByName(again)

    @cached_property
    def raw_labs(self) -> DataFrame:
        return self.load("lineitem").select(
            F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").alias("itemid"),
            F.col("l_shipdate").alias("charttime"),
            F.when(F.col("l_quantity") % 10 != 0, F.col("l_extendedprice")).alias("valuenum"),
            F.col("l_returnflag").alias("valueuom"), F.col("l_linestatus").alias("flag"),
        )

    # -- orders view: conformed -------------------------------------------------

    @cached_property
    def patients(self) -> DataFrame:
        return cleaning.clean_patients(self.raw_patients, ORDER_RULES)

    @cached_property
    def admissions(self) -> DataFrame:
        return cleaning.clean_admissions(self.raw_admissions)

    @cached_property
    def diagnoses(self) -> DataFrame:
        """The join with the orders, the choice of one row per code and what counts codes
        share their tasks, each with its own sorts and maps. Partitions put together by
        their packed bytes hold millions of lines, so with many orders the tasks follow
        the lines. A few orders are broadcast, and a busy one is not brought together."""
        tasks = None
        if self.load("orders").count() > FEW_ORDERS:
            tasks = -(-self.load("lineitem").count() // TASK_LINES)
        return cleaning.clean_diagnoses(self.coded_lines(tasks), ORDER_RULES)

    @cached_property
    def dictionary(self) -> DataFrame:
        return cleaning.clean_lab_dictionary(self.raw_dictionary, ORDER_RULES)

    @cached_property
    def labs(self) -> DataFrame:
        return materialise(self.labs_plan, "labs")

    @cached_property
    def labs_plan(self) -> DataFrame:
        return cleaning.clean_events(
            self.raw_labs, self.admissions, self.dictionary, ORDER_RULES
        )

    @cached_property
    def cohort(self) -> DataFrame:
        return materialise(self.cohort_plan, "cohort")

    @cached_property
    def cohort_plan(self) -> DataFrame:
        return cohort.build_cohort(
            self.patients, self.admissions, self.diagnoses, ORDER_RULES, mode="md5"
        )

    # -- activity view ----------------------------------------------------------

    @cached_property
    def user_stays(self) -> DataFrame:
        return materialise(self.user_stays_plan, "user-stays")

    @cached_property
    def user_stays_plan(self) -> DataFrame:
        opened = self.load("events").where("event_type = 'signup'").select(
            F.col("user_id").alias("subject_id"), F.col("event_id").alias("hadm_id"),
            F.col("ts").alias("admittime"),
        )
        return next_in_key(opened, "subject_id", "admittime", "hadm_id", "dischtime").select(
            "subject_id", "hadm_id", "admittime", "dischtime"
        )

    @cached_property
    def user_draws(self) -> DataFrame:
        kind = F.col("event_type")
        numbers = F.create_map(*[F.lit(x) for pair in ITEM_NUMBERS.items() for x in pair])
        return self.load("events").where(kind != "signup").select(
            "event_id", F.col("user_id").alias("subject_id"),
            numbers[kind].alias("itemid"), kind.alias("label"),
            kind.isin(*ACUTE_EVENTS).alias("is_acute_marker"),
            F.col("ts").alias("charttime"), F.col("value").alias("valuenum"),
        )

    @cached_property
    def user_labs(self) -> DataFrame:
        return materialise(self.user_labs_plan, "user-labs")

    @cached_property
    def user_labs_plan(self) -> DataFrame:
        """Draws inside the stays of their user."""
        inside = interval_join(
            self.user_draws, self.user_stays, by="subject_id", at="charttime",
            start="admittime", end="dischtime",
        )
        return inside.select(
            "subject_id", "hadm_id", "event_id", "itemid", "label", "is_acute_marker",
            F.when(F.col("is_acute_marker"), "acute").otherwise("routine").alias("marker_type"),
            "charttime", elapsed_hours("admittime", "charttime", 3).alias("hours_from_admit"),
            "valuenum",
        )

    @cached_property
    def user_points(self) -> DataFrame:
        """Clicks as point records without a stay."""
        return self.load("events").where("event_type = 'click'").select(
            F.col("user_id").alias("subject_id"), F.col("event_id").alias("study_id"),
            F.concat(F.lit("rec"), F.col("event_id").cast("string")).alias("file_name"),
            F.col("ts").alias("ecg_time"),
            F.concat(F.lit("files/u"), F.col("user_id").cast("string"), F.lit("/"),
                     (F.col("event_id") % 10).cast("string"),
                     F.when(F.col("event_id") % 2 == 0, ".hea").otherwise(".dat")).alias("path"),
        )

    @cached_property
    def user_patients(self) -> DataFrame:
        """One record per user; the distinct is combined map-side."""
        key = F.col("subject_id")
        raw = self.load("events").select(F.col("user_id").alias("subject_id")).distinct().select(
            key,
            F.when(key % 3 == 0, "M").when(key % 3 == 1, "f").alias("gender"),
            (10 + key % 85).cast("int").alias("anchor_age"),
            (2100 + key % 10).cast("int").alias("anchor_year"),
            F.lit("all").alias("anchor_year_group"),
            F.lit(None).cast("timestamp_ntz").alias("dod"),
        )
        return cleaning.clean_patients(raw, ACTIVITY_RULES)

    @cached_property
    def user_admissions(self) -> DataFrame:
        key = F.col("hadm_id")
        return cleaning.clean_admissions(self.user_stays.select(
            "*",
            F.concat(F.lit("type "), (key % 3).cast("string")).alias("admission_type"),
            F.lit("web").alias("admission_location"), F.lit("web").alias("discharge_location"),
            F.concat(F.lit("plan "), (key % 4).cast("string")).alias("insurance"),
            F.lit("na").alias("marital_status"),
            F.concat(F.lit("group "), (F.col("subject_id") % 5).cast("string")).alias("race"),
            F.when(key % 11 == 0, F.lit(1)).alias("hospital_expire_flag"),
        ))

    @cached_property
    def user_diagnoses(self) -> DataFrame:
        raw = self.user_labs.select(
            "subject_id", "hadm_id", (F.col("event_id") % 9).cast("int").alias("seq_num"),
            F.concat(F.lower("label"), F.lit("."),
                     F.floor(F.col("valuenum") / 150).cast("string")).alias("icd_code"),
            F.lit(10).alias("icd_version"),
        )
        return cleaning.clean_diagnoses(raw, ACTIVITY_RULES)

    @cached_property
    def user_cohort(self) -> DataFrame:
        return materialise(self.user_cohort_plan, "user-cohort")

    @cached_property
    def user_cohort_plan(self) -> DataFrame:
        return cohort.build_cohort(
            self.user_patients, self.user_admissions, self.user_diagnoses, ACTIVITY_RULES,
            mode="md5",
        )

    @cached_property
    def user_features(self) -> DataFrame:
        return features.lab_features(self.user_labs)

    @cached_property
    def user_wide(self) -> DataFrame:
        return features.pivot_features(self.user_features)

    @cached_property
    def user_matches(self) -> DataFrame:
        return cleaning.clean_point_records(self.user_points, self.user_stays)

    @cached_property
    def user_mart(self) -> DataFrame:
        return materialise(self.user_mart_plan, "user-mart")

    @cached_property
    def user_mart_plan(self) -> DataFrame:
        return features.build_feature_mart(self.user_cohort, self.user_wide, self.user_matches)

    @cached_property
    def user_coverage(self) -> DataFrame:
        return features.coverage_report(self.user_mart, list(ITEM_NUMBERS))

    def published(self, df: DataFrame, name: str) -> DataFrame:
        return with_lineage(df, f"gold.{name}", "run-1", F.expr(LOADED_AT))

    @cached_property
    def staged_cohort(self) -> DataFrame:
        return warehouse.stg_cohort(self.published(self.user_cohort, "cohort"))

    @cached_property
    def staged_features(self) -> DataFrame:
        return warehouse.stg_lab_features(self.published(self.user_features, "lab_features"))

    @cached_property
    def panel(self) -> DataFrame:
        return warehouse.int_cohort_lab_panel(self.staged_cohort, self.staged_features)

    @cached_property
    def staged_coverage(self) -> DataFrame:
        return warehouse.stg_feature_coverage(
            self.published(self.user_coverage, "feature_coverage")
        )

    # -- histories ----------------------------------------------------------------

    @cached_property
    def dq_results(self) -> DataFrame:
        """Quality results of five runs: orders summarised per run, layer and table."""
        run = F.col("o_orderkey") % 5
        summarised = self.load("orders").groupBy(
            run.alias("run"), F.col("o_orderstatus").alias("layer"),
            F.col("o_orderpriority").alias("table_name"),
        ).agg(F.count(F.lit(1)).alias("row_count"),
              F.count_if(F.col("o_orderkey") % 7 == 0).alias("sevens"))
        checks = F.array(*[
            F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"),
                     F.lit(m).alias("modulus"))
            for n, s, m in (("row_count_between_1_inf", "error", 13),
                            ("not_null__o_custkey", "error", 7), ("null_rate__o_clerk", "warn", 3))
        ])
        observed = (F.col("sevens") % F.col("modulus")).cast("double")
        return summarised.select("*", F.inline(checks)).select(
            F.concat(F.lit("run-"), F.col("run").cast("string")).alias("run_id"),
            (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + days(F.col("run"))).alias("checked_at"),
            "layer", "table_name", "check_name", "severity",
            (observed != 1).cast("string").alias("passed"),
            observed.alias("observed"), F.lit(0.0).alias("threshold"), "row_count",
            F.concat(F.lit("observed "), (F.col("sevens") % F.col("modulus")).cast("string"))
            .alias("details"),
        )

    @cached_property
    def coverage_history(self) -> DataFrame:
        """Null rates of three columns over seven runs (one per line number)."""
        run = F.col("l_linenumber")
        counts = self.load("lineitem").groupBy(run.alias("run")).agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("l_tax") > 0.02 * (run - 3)).alias("tax"),
            F.count_if(F.col("l_discount") > 0.01 * run).alias("discount"),
            F.count_if(F.col("l_quantity") > 10).alias("quantity"),
        )
        return counts.unpivot(
            ["run", "total_rows"], ["tax", "discount", "quantity"], "column_name", "non_null_rows"
        ).select(
            F.concat(F.lit("run-"), F.col("run").cast("string")).alias("_run_id"), "column_name",
            "non_null_rows", "total_rows",
            F.round(1 - F.col("non_null_rows") / F.col("total_rows"), 6).alias("null_rate"),
        )

    # -- scored rows --------------------------------------------------------------

    @cached_property
    def scored(self) -> DataFrame:
        """Orders as labelled rows, with a score of two models derived by hash."""
        label = (F.col("o_orderstatus") == "F").cast("int")
        rows = self.load("orders").select(
            F.col("o_orderkey").alias("row_id"), (F.col("o_orderkey") % 5).alias("run"),
            label.alias("label"),
            F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model_name"),
        )
        uniform = hash_ordinal(F.concat_ws("-", "model_name", F.col("row_id").cast("string")),
                               "score", "md5") / F.lit(4294967296.0)
        weight = F.when(F.col("model_name") == MODELS[0], 0.2).otherwise(0.3)
        score = F.floor(((1 - weight) * uniform + weight * F.col("label")) * 1000) / 1000.0
        bucket = hash_bucket("row_id", "split", 100, "md5")
        return rows.withColumn("score", score).withColumn(
            "split", F.when(bucket < 70, "train").when(bucket < 85, "validation").otherwise("test")
        ).withColumn("logit", 6 * F.col("score") - 3)

    @cached_property
    def model_metrics(self) -> DataFrame:
        return materialise(self.model_metrics_plan, "model-metrics")

    @cached_property
    def model_metrics_plan(self) -> DataFrame:
        """Metric history: five runs, two models, three splits."""
        groups = ["run", "model_name", "split"]
        names = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
        long = evaluate(self.scored, groups).unpivot(
            [*groups, "n_rows"], names, "metric_name", "metric_value"
        )
        return long.select(
            F.concat(F.lit("run-"), F.col("run").cast("string")).alias("run_id"),
            (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + days(F.col("run"))).alias("trained_at"),
            "model_name", "split", "metric_name",
            F.round("metric_value", 6).alias("metric_value"),
            "n_rows", F.lit(12).alias("n_features"),
        )

    def suite_rows(self, suite: Suite, df: DataFrame) -> DataFrame:
        """A suite's outcomes, with observed values at a comparable precision."""
        return suite.evaluate(df).select(
            "check_name", "severity", "passed", F.round("observed", 6).alias("observed"),
            "threshold", "row_count",
        )
