"""Data-quality suites evaluated in one pass, as a DataFrame of results."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.sources.lake import current_run_id

log = logging.getLogger("cohortloom.quality")

RESULT_COLUMNS = (
    "run_id", "checked_at", "layer", "table_name", "check_name", "severity", "passed",
    "observed", "threshold", "row_count", "details",
)
OUTCOME_COLUMNS = ("check_name", "severity", "passed", "observed", "threshold", "row_count",
                   "details")


class QualityError(RuntimeError):
    """A blocking check failed."""


def rows() -> Column:
    return F.count(F.lit(1))


def _share(count: Column) -> Column:
    return F.try_divide(count.cast("double"), rows().cast("double"))


@dataclass(frozen=True)
class Check:
    """A pass rule over one aggregate of the table."""

    name: str
    severity: str
    observed: Column
    rule: Callable[[Column], Column]
    threshold: float
    wording: str
    #: what an empty table is reported as; None means the rule decides
    on_empty: float | None = None


@dataclass(frozen=True)
class UniqueCheck:
    name: str
    severity: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class FrameCheck:
    """A check that needs its own plan: DataFrame -> one row (observed, passed)."""

    name: str
    severity: str
    evaluate: Callable[[DataFrame], DataFrame]
    threshold: float
    wording: str


@dataclass
class Suite:
    """Declared expectations of one table.

    Every single-column rule is a counter in one shared aggregation, so a suite
    costs one pass however many rules it has. Key uniqueness needs a shuffle of
    its own: rows are counted per key with map-side combining, which a key that
    repeats in a third of the table does not slow down.
    """

    layer: str
    table: str
    checks: list = field(default_factory=list)

    def _add(self, check) -> Suite:
        self.checks.append(check)
        return self

    def _none_of(self, name: str, severity: str, violation: Column, wording: str) -> Suite:
        return self._add(Check(name, severity, F.count_if(violation), lambda n: n == 0, 0.0,
                               wording))

    def row_count_between(self, minimum: int, maximum: int | None = None,
                          severity: str = "error") -> Suite:
        upper = "inf" if maximum is None else maximum

        def rule(n: Column) -> Column:
            return n >= minimum if maximum is None else n.between(minimum, maximum)

        return self._add(Check(f"row_count_between_{minimum}_{upper}", severity, rows(), rule,
                               float(minimum), "rows"))

    def not_null(self, column: str, severity: str = "error") -> Suite:
        return self._none_of(f"not_null__{column}", severity, F.col(column).isNull(),
                             f"null values in {column}")

    def unique(self, keys: Sequence[str], severity: str = "error") -> Suite:
        return self._add(UniqueCheck(f"unique__{'_'.join(keys)}", severity, tuple(keys)))

    def values_in(self, column: str, allowed: Sequence, severity: str = "error") -> Suite:
        outside = ~F.col(column).isin(list(allowed))
        return self._none_of(f"values_in__{column}", severity, outside,
                             f"values of {column} outside the allowed set")

    def between(self, column: str, low: float, high: float, severity: str = "error") -> Suite:
        outside = ~F.col(column).between(low, high)
        return self._none_of(f"between__{column}", severity, outside,
                             f"values of {column} outside [{low}, {high}]")

    def null_rate_below(self, column: str, maximum: float, severity: str = "warn") -> Suite:
        return self._add(Check(f"null_rate__{column}", severity,
                               _share(F.count_if(F.col(column).isNull())),
                               lambda share: share <= maximum, float(maximum),
                               f"null share of {column}", on_empty=1.0))

    def class_balance(self, column: str, low: float, high: float,
                      severity: str = "warn") -> Suite:
        return self._add(Check(f"class_balance__{column}", severity,
                               _share(F.count_if(F.col(column) == 1)),
                               lambda share: share.between(low, high), float(low),
                               f"share of {column} = 1", on_empty=0.0))

    def custom(self, name: str, violations: Column | Callable[[DataFrame], DataFrame],
               severity: str = "error", wording: str = "violations") -> Suite:
        """Any other rule: an aggregate counting violations, or a callable that
        returns one row (observed, passed) when an aggregate cannot say it."""
        if callable(violations):
            return self._add(FrameCheck(name, severity, violations, 0.0, wording))
        return self._add(Check(name, severity, violations, lambda n: n == 0, 0.0, wording))

    # -- evaluation ---------------------------------------------------------

    def _fused(self, df: DataFrame) -> DataFrame:
        checks = [c for c in self.checks if isinstance(c, Check)]
        numbers = df.agg(
            rows().alias("row_count"),
            *[c.observed.cast("double").alias(f"_{i}") for i, c in enumerate(checks)],
        )

        def outcome(i: int, check: Check) -> Column:
            seen = F.col(f"_{i}")
            verdict = F.coalesce(check.rule(seen), F.lit(False))
            if check.on_empty is not None:
                verdict = F.when(F.col("row_count") == 0, F.lit(False)).otherwise(verdict)
                seen = F.coalesce(seen, F.lit(check.on_empty))
            return F.struct(
                F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
                verdict.alias("passed"), seen.alias("observed"),
                F.lit(check.threshold).alias("threshold"),
                F.lit(check.wording).alias("_wording"),
            )

        outcomes = F.array(*[outcome(i, c) for i, c in enumerate(checks)])
        return numbers.select("row_count", F.inline(outcomes))

    @staticmethod
    def _unique(df: DataFrame, check: UniqueCheck) -> DataFrame:
        groups = df.groupBy(*check.keys).agg(rows().alias("_n"))
        repeats = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        return groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
            (repeats == 0).alias("passed"), repeats.cast("double").alias("observed"),
            F.lit(0.0).alias("threshold"),
            F.lit(f"duplicate keys on {', '.join(check.keys)}").alias("_wording"),
        )

    @staticmethod
    def _frame(df: DataFrame, check: FrameCheck) -> DataFrame:
        total = df.agg(rows().alias("n")).scalar()
        return check.evaluate(df).select(
            total.alias("row_count"),
            F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
            F.col("passed"), F.col("observed").cast("double").alias("observed"),
            F.lit(check.threshold).alias("threshold"), F.lit(check.wording).alias("_wording"),
        )

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One row per check, lazily."""
        parts = []
        if any(isinstance(c, Check) for c in self.checks):
            parts.append(self._fused(df))
        parts += [self._unique(df, c) for c in self.checks if isinstance(c, UniqueCheck)]
        parts += [self._frame(df, c) for c in self.checks if isinstance(c, FrameCheck)]
        results = reduce(DataFrame.unionByName, parts)
        seen = F.when(
            F.col("observed") == F.floor("observed"), F.col("observed").cast("long").cast("string")
        ).otherwise(F.format_number("observed", 3))
        return results.withColumn("details", F.concat_ws(" ", seen, "_wording")).select(
            *OUTCOME_COLUMNS
        )

    def results(self, df: DataFrame, run_id: str | None = None) -> DataFrame:
        """The outcome rows with run, table and time, as they are persisted."""
        return self.evaluate(df).select(
            F.lit(run_id or current_run_id()).alias("run_id"),
            F.current_timestamp().alias("checked_at"),
            F.lit(self.layer).alias("layer"), F.lit(self.table).alias("table_name"),
            "check_name", "severity", F.col("passed").cast("string").alias("passed"),
            "observed", "threshold", "row_count", "details",
        )

    def run(self, df: DataFrame, *, persist_to: str | None = None, run_id: str | None = None,
            raise_on_error: bool = True) -> list:
        """Evaluate, log, persist, then fail on blocking checks.

        The driver receives one row per declared check and nothing else.
        """
        spark = df.sparkSession
        found = self.results(df, run_id)
        outcomes = found.collect()
        for row in outcomes:
            ok = row.passed == "true"
            level = logging.INFO if ok else (
                logging.ERROR if row.severity == "error" else logging.WARNING
            )
            log.log(level, "%s.%s %s passed=%s (%s)", self.layer, self.table, row.check_name,
                    row.passed, row.details)
        if persist_to:
            persist_results(spark.createDataFrame(outcomes, found.schema), persist_to)
        blocking = [r for r in outcomes if r.passed != "true" and r.severity == "error"]
        if blocking and raise_on_error:
            reasons = "; ".join(f"{r.check_name}: {r.details}" for r in blocking)
            raise QualityError(f"{self.layer}.{self.table}: {reasons}")
        return outcomes


def persist_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").partitionBy("layer", "table_name").parquet(path)


def one_split_per_subject(df: DataFrame) -> DataFrame:
    """Subjects beyond their first row: none may appear in more than one place."""
    per_subject = df.groupBy("subject_id").agg(rows().alias("_n"))
    extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return per_subject.agg(extra.alias("observed"), (extra == 0).alias("passed"))
