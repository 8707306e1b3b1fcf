"""The model DAG as plain functions of the raw zone.

``Models`` wires staging -> sessions -> marts with explicit dependencies and
memoises each DataFrame, so a model used by several marts is one analysed
subtree (within one query Spark reuses its identical exchanges). For the
materialised, lineage-cutting version of the same DAG see ``warehouse.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import marts, sessions, staging
from cartwheel.sources import fixtures, sinks


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, strict: bool = False, raw: dict | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.strict = strict
        self._raw = raw

    # ---- raw zone
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """The raw zone: given, or read straight from the driver tables."""
        return self._raw if self._raw is not None else fixtures.raw_zone(self.spark, self.sf_dir)

    @property
    def raw_events(self) -> DataFrame:
        return self.raw["raw_events"]

    def written(self, *names: str) -> Models:
        """The same DAG with the named models written to the shared scratch folder once and
        read back, for queries that would otherwise compute them several times."""
        for name in names:
            path = sinks.scratch_root(self.spark, name)
            sinks.write_table(self.table(name), path)
            self.__dict__[name] = self.spark.read.schema(self.table(name).schema).parquet(path)
        return self

    def bucketed(self, **keys: str) -> Models:
        """The same DAG with written models bucketed by a key each, if no key is too large."""
        for name, key in keys.items():
            self.written(name)
            self.__dict__[name] = sinks.write_bucketed(self.table(name), name, key)
        return self

    def sorted_out(self) -> Models:
        """The same DAG with the raw events read once: every row is written to the scratch
        folder under its status (valid, rejected, or neither, trap T1), so the clean events
        read only the valid rows, the quarantine only the rejected ones, and counting
        either needs the file footers alone."""
        raw = self.raw_events
        status = F.when(staging.is_valid(self.strict), "valid").when(staging.is_rejected(self.strict), "rejected").otherwise("neither")
        path = sinks.scratch_root(self.spark, "events-by-status")
        raw.withColumn("_status", status).write.mode("overwrite").partitionBy("_status").parquet(path)
        schema = raw.schema.add("_status", "string")
        back = self.spark.read.schema(schema).parquet(path)
        self.__dict__["raw"] = {**self.raw, "raw_events": back.drop("_status")}
        valid = back.filter("_status = 'valid'").drop("_status")
        self.__dict__["stg_events"] = staging.typed_events(staging.dedup_first(valid.select(*staging.CLEAN_COLUMNS)))
        rejected = back.filter("_status = 'rejected'").drop("_status")
        self.__dict__["stg_events_rejected"] = rejected.withColumn("reject_reason", staging.reject_reason(self.strict))
        return self

    # ---- staging
    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw_events, strict=self.strict)

    @cached_property
    def stg_events_rejected(self) -> DataFrame:
        return staging.stg_events_rejected(self.raw_events, strict=self.strict)

    @cached_property
    def stg_ad_spend(self) -> DataFrame:
        return staging.stg_ad_spend(self.raw["raw_ad_spend"])

    @cached_property
    def stg_crm_customers(self) -> DataFrame:
        return staging.stg_crm_customers(self.raw["raw_crm_customers"])

    # ---- intermediate
    @cached_property
    def int_sessions(self) -> DataFrame:
        return sessions.int_sessions(self.stg_events)

    # ---- marts
    @cached_property
    def mart_customer_features(self) -> DataFrame:
        return marts.mart_customer_features(self.int_sessions)

    @cached_property
    def mart_funnel(self) -> DataFrame:
        return marts.mart_funnel(self.int_sessions)

    @cached_property
    def mart_campaign_efficiency(self) -> DataFrame:
        return marts.mart_campaign_efficiency(self.int_sessions, self.stg_ad_spend)

    @cached_property
    def mart_product_affinity(self) -> DataFrame:
        return marts.mart_product_affinity(self.stg_events)

    @cached_property
    def mart_cohort_retention(self) -> DataFrame:
        return marts.mart_cohort_retention(self.int_sessions, self.stg_crm_customers)

    @cached_property
    def campaign_efficiency_events(self) -> DataFrame:
        return marts.campaign_efficiency_events(self.stg_events, self.stg_ad_spend)

    # names of the ten models of the layered run, in layer order
    LAYERED = [
        ("staging", "stg_ad_spend"),
        ("staging", "stg_crm_customers"),
        ("staging", "stg_events"),
        ("staging", "stg_events_rejected"),
        ("intermediate", "int_sessions"),
        ("marts", "mart_campaign_efficiency"),
        ("marts", "mart_cohort_retention"),
        ("marts", "mart_customer_features"),
        ("marts", "mart_funnel"),
        ("marts", "mart_product_affinity"),
    ]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self, names: list[str] | None = None) -> list[str]:
        """Expose the models as temporary views, so they can be queried with ``spark.sql``
        like warehouse tables (lazy: a view is planned into each query that uses it)."""
        names = names or [m for _, m in self.LAYERED] + ["campaign_efficiency_events"]
        for n in names:
            self.table(n).createOrReplaceTempView(n)
        return names


class ModelTables:
    """Read-only mapping ``name -> DataFrame`` over a :class:`Models` plus extra tables."""

    def __init__(self, models: Models, extra: dict[str, DataFrame] | None = None):
        self.models = models
        self.extra = dict(extra or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.extra:
            return self.extra[name]
        if name == "raw_events":
            return self.models.raw_events
        if name in {m for _, m in Models.LAYERED} or name == "campaign_efficiency_events":
            return self.models.table(name)
        raise KeyError(name)

    def __contains__(self, name: str) -> bool:
        try:
            self[name]
            return True
        except KeyError:
            return False
