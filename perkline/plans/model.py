"""Lazily composed derived frames of one data directory.

``BenefitModel`` wires the bound tables into the BI, eligibility and KPI
plans.  Nothing is computed here: every property returns a lazy DataFrame,
and Catalyst optimises each consuming query as a whole.  Only a run that reads
the per-employee views many times keeps them (``kept``), and lets them go at
its end.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from perkline.config import DEFAULT_RUN, RunConfig
from perkline.plans import bi, eligibility, kpi
from perkline.plans.params import effective_params, param_pivot
from perkline.sources.tables import Tables


class BenefitModel:
    def __init__(self, spark: SparkSession, sf_dir: str, run: RunConfig = DEFAULT_RUN, tables: Tables | None = None):
        self.spark = spark
        self.run = run
        self.t = tables or Tables(spark, sf_dir, run)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, run: RunConfig = DEFAULT_RUN) -> "BenefitModel":
        return cls(spark, sf_dir, run)

    # -- parameters ----------------------------------------------------------
    @cached_property
    def params(self) -> DataFrame:
        return self.t.params()

    @cached_property
    def effective_params(self) -> DataFrame:
        return effective_params(self.params, self.run.as_of)

    @cached_property
    def pivot(self) -> DataFrame:
        return param_pivot(self.effective_params)

    # -- base tables ---------------------------------------------------------
    @cached_property
    def roster(self) -> DataFrame:
        return self.t.roster()

    @cached_property
    def link(self) -> DataFrame:
        return self.t.link()

    @cached_property
    def activities(self) -> DataFrame:
        return self.t.activities()

    @cached_property
    def commute_checks(self) -> DataFrame:
        return self.t.commute_checks()

    # -- BI views ------------------------------------------------------------
    @cached_property
    def bi_activity(self) -> DataFrame:
        # fact-sized: not kept, so each consumer's filter reaches the scan
        return bi.bi_activity(self.activities, self.run.zone)

    @cached_property
    def bi_employee(self) -> DataFrame:
        return bi.bi_employee(self.link, self.roster)

    @cached_property
    def bi_commute(self) -> DataFrame:
        return bi.bi_commute(self.commute_checks)

    @cached_property
    def salaries(self) -> DataFrame:
        return eligibility.salaries(self.link, self.roster)

    # -- eligibility ---------------------------------------------------------
    @cached_property
    def activity_counts(self) -> DataFrame:
        return eligibility.activity_count_window(self.bi_activity, self.run)

    @cached_property
    def bonus(self) -> DataFrame:
        return eligibility.bonus_eligibility(self.bi_employee, self.bi_commute, self.salaries)

    @cached_property
    def wellbeing(self) -> DataFrame:
        return eligibility.wellbeing_eligibility(self.bi_employee, self.activity_counts, self.pivot, self.run)

    @cached_property
    def benefits(self) -> DataFrame:
        return eligibility.benefit_category(self.bi_employee, self.bonus, self.wellbeing)

    # -- KPIs ----------------------------------------------------------------
    def kpi_bonus_cost(self) -> DataFrame:
        return kpi.kpi_bonus_cost(self.bonus, self.salaries, self.pivot)

    def kpi_bonus_cost_fixed(self) -> DataFrame:
        return kpi.kpi_bonus_cost_fixed(self.bonus, self.pivot)

    def kpi_extra_days(self) -> DataFrame:
        return kpi.kpi_extra_days(self.wellbeing, self.pivot)

    def kpi_activity_mix(self) -> DataFrame:
        return kpi.kpi_activity_mix(self.bi_activity, self.run)

    def kpi_incoherences(self) -> DataFrame:
        return kpi.kpi_incoherences(self.bi_commute)

    def kpi_age(self) -> DataFrame:
        return kpi.kpi_age(self.bi_employee, self.bonus, self.wellbeing, self.salaries, self.pivot, self.run)

    def kpis(self) -> dict[str, DataFrame]:
        return {
            "age": self.kpi_age(),
            "cout_prime": self.kpi_bonus_cost(),
            "cout_prime_fixe": self.kpi_bonus_cost_fixed(),
            "incoherences": self.kpi_incoherences(),
            "jours_sup": self.kpi_extra_days(),
            "pratique_sport": self.kpi_activity_mix(),
        }

    @contextmanager
    def kept(self):
        """Keeps the per-employee views while a run reads them many times
        (MEMORY_AND_DISK; a lost executor's blocks are recomputed).  Their
        size follows the employees, not the activity facts."""
        views = [getattr(self, name) for name in ("bi_employee", "bi_commute", "bonus", "wellbeing")]
        for view in views:
            view.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield self
        finally:
            for view in views:
                view.unpersist()
