"""The declared assertions of the published models, and the runner that counts offenders.

Rules on single rows of a model are counted together in one pass over it; rules on keys
and between models are one counted join or group each. Everything is one plan until
the outcomes are collected, one row per assertion.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import assertions as find
from cohortloom.operators.quality import QualityError
from cohortloom.rules import RULES, StudyRules

Models = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Assertion:
    """``bad`` tells offending rows of the model one by one; ``rows`` gives the offenders of
    what cannot be told from one row. One of them is set."""

    model: str
    name: str
    bad: Column | None = None
    rows: Callable[[Models], DataFrame] | None = None
    severity: str = "error"

    def offenders(self, models: Models) -> DataFrame:
        return self.rows(models) if self.rows else models[self.model].where(self.bad)


class Contract:
    """Collects the assertions of one model."""

    def __init__(self, model: str):
        self.model, self.assertions = model, []

    def _add(self, name: str, **how) -> Contract:
        self.assertions.append(Assertion(self.model, name, **how))
        return self

    def not_null(self, *columns: str) -> Contract:
        for c in columns:
            self._add(f"not_null__{c}", bad=F.col(c).isNull())
        return self

    def accepted(self, column: str, values: Sequence) -> Contract:
        return self._add(f"accepted_values__{column}", bad=~F.col(column).isin(list(values)))

    def within(self, column: str, low=None, high=None) -> Contract:
        below = F.lit(False) if low is None else F.col(column) < low
        above = F.lit(False) if high is None else F.col(column) > high
        return self._add(f"accepted_range__{column}", bad=below | above)

    def unique(self, *columns: str) -> Contract:
        """Keys that several rows have; a single key that is null is left to ``not_null``."""
        def rows(models: Models) -> DataFrame:
            df = models[self.model]
            if len(columns) == 1:
                return find.repeated_values(df, columns[0])
            return find.repeated_combinations(df, columns)

        return self._add(f"unique__{'_'.join(columns)}", rows=rows)

    def refers(self, column: str, parent: str, parent_column: str | None = None) -> Contract:
        return self._add(f"relationships__{column}__{parent}", rows=lambda models: find.orphans(
            models[self.model], column, models[parent], parent_column or column))

    def also(self, name: str, rows: Callable[[DataFrame], DataFrame], severity: str = "error"
             ) -> Contract:
        return self._add(name, rows=lambda models: rows(models[self.model]), severity=severity)


def declared(rules: StudyRules = RULES) -> list[Assertion]:
    """The contracts of the models, by the names of ``warehouse.build_models``."""
    ages = ["under_45", "45_64", "65_79", "80_plus"]
    contracts = (
        Contract("dim_patient").not_null("subject_id").unique("subject_id")
        .accepted("age_group", ages).accepted("has_angina", [0, 1]),
        Contract("fct_admission").not_null("hadm_id", "subject_id").unique("hadm_id")
        .refers("subject_id", "dim_patient").within("length_of_stay_days", low=0)
        .within("total_lab_measurements", low=0),
        Contract("fct_lab_result").unique("hadm_id", "lab_itemid").not_null("lab_result_key")
        .unique("lab_result_key").refers("hadm_id", "fct_admission")
        .also("aggregation_rule_matches_marker", find.wrong_aggregation_rule),
        Contract("mart_angina_training_features").not_null("hadm_id", "subject_id", "label", "split", "age")
        .unique("hadm_id").unique("subject_id").accepted("label", [0, 1])
        .accepted("split", ["train", "validation", "test"])
        .within("age", rules.adult_age, rules.age_range[1])
        .also("class_balance", find.class_balance, "warn")
        .also("every_split_has_both_classes", find.one_class_splits)
        .also("no_subject_across_splits", find.subjects_across_splits),
        Contract("analytics_lab_profile_by_cohort").not_null("lab_name"),
        Contract("analytics_feature_coverage").accepted(
            "completeness_tier", ["complete", "partial", "sparse", "mostly_missing"])
        .also("features_not_imputed", find.imputed_features),
    )
    return [a for c in contracts for a in c.assertions]


def outcomes(models: Models, assertions: Sequence[Assertion] | None = None) -> DataFrame:
    """One row per assertion on a model that is there: model, assertion, severity, offenders
    and passed."""
    chosen = [a for a in assertions or declared() if a.model in models]
    frames = []
    for model in dict.fromkeys(a.model for a in chosen):
        on_rows = [a for a in chosen if a.model == model and a.bad is not None]
        if on_rows:
            counted = models[model].agg(*(
                F.count_if(a.bad).alias(str(i)) for i, a in enumerate(on_rows)))
            frames.append(counted.select(F.inline(F.array(*(F.struct(
                F.lit(a.model).alias("model"), F.lit(a.name).alias("assertion"),
                F.lit(a.severity).alias("severity"), F.col(str(i)).alias("offenders"))
                for i, a in enumerate(on_rows))))))
    for a in chosen:
        if a.rows is not None:
            frames.append(a.rows(models).agg(F.count(F.lit(1)).alias("offenders")).select(
                F.lit(a.model).alias("model"), F.lit(a.name).alias("assertion"),
                F.lit(a.severity).alias("severity"), "offenders"))
    return reduce(DataFrame.unionByName, frames).withColumn("passed", F.col("offenders") == 0)


def enforce(models: Models, assertions: Sequence[Assertion] | None = None) -> DataFrame:
    """The outcomes as a table of the driver, one row each; raises if an error was found."""
    found = outcomes(models, assertions)
    rows = found.collect()
    broken = [f"{r.model}.{r.assertion}: {r.offenders}" for r in rows
              if r.severity == "error" and not r.passed]
    if broken:
        raise QualityError("; ".join(broken))
    return found.sparkSession.createDataFrame(rows, found.schema)
