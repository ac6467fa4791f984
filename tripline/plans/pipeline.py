"""The pipeline bound to a set of driver tables.

``Pipeline(spark, sf_dir)`` exposes every stage as a lazy DataFrame: raw
trips -> cleaned -> deduplicated -> enriched -> daily-zone / hourly
aggregates -> anomaly scores -> quality checks.  Nothing runs until a
caller acts on one of them, and each query plan contains exactly the
stages it needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.model import ORDERS_MODEL, TripModel
from tripline.operators import aggregates, anomaly, clean, enrich, quality
from tripline.plans import views
from tripline.sources import drift, tables
from tripline.sources.files import ingest_manifest


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, model: TripModel = ORDERS_MODEL,
                 with_copies: bool = False):
        """Plans that use the trips in several branches (checks, step counts,
        summary) share one deduplication shuffle: it is on whole rows, so the
        branches' exchanges are equal and Spark runs it once."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.model = model
        self.with_copies = with_copies

    # --- sources --------------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return tables.order_trips(self.spark, self.sf_dir, self.with_copies)

    @cached_property
    def zones(self) -> DataFrame:
        return tables.zones(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return tables.event_trips(self.spark, self.sf_dir)

    def source_paths(self, names=tables.TRIP_SOURCE_TABLES) -> list[str]:
        return [tables.table_path(self.sf_dir, n) for n in names]

    @cached_property
    def manifest(self) -> DataFrame:
        return ingest_manifest(self.spark, self.source_paths())

    # --- ETL stages -----------------------------------------------------------
    @cached_property
    def cleaned(self) -> DataFrame:
        return clean.clean(self.raw, self.model)

    @cached_property
    def deduped(self) -> DataFrame:
        return clean.dedupe(self.cleaned)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich(self.deduped, self.zones, self.model)

    @cached_property
    def trips(self) -> DataFrame:
        return self.enriched

    @cached_property
    def daily(self) -> DataFrame:
        return aggregates.daily_zone(self.trips, self.model)

    @cached_property
    def hourly(self) -> DataFrame:
        return aggregates.hourly_profile(self.trips, self.model.fare)

    @cached_property
    def event_hourly(self) -> DataFrame:
        """Hour x weekday x type profile of events (hours vary there)."""
        return aggregates.hourly_profile(self.events, "fare")

    @cached_property
    def series(self) -> DataFrame:
        return aggregates.citywide_and_borough(self.daily)

    @cached_property
    def flags(self) -> DataFrame:
        return anomaly.anomalies(self.series)

    # --- counts and checks ----------------------------------------------------
    def _bag(self, parts: dict[str, DataFrame]) -> DataFrame:
        """Union one-row aggregates as (name, value) and widen them with one
        global aggregate: several counts in one plan, no joins."""
        bag = None
        for one in parts.values():
            cols = one.columns
            row = one.select(*[F.col(c).cast("bigint").alias(c) for c in cols]).unpivot(
                [], cols, "name", "value"
            )
            bag = row if bag is None else bag.unionByName(row)
        names = [c for one in parts.values() for c in one.columns]
        return bag.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])

    @cached_property
    def ingest_rows(self) -> DataFrame:
        """Rows ingested at the trip grain (the manifest of the grain file)."""
        grain = self.source_paths((tables.TRIP_GRAIN_TABLE,))
        return ingest_manifest(self.spark, grain).agg(F.sum("rows").alias("ingest_total_rows"))

    @cached_property
    def step_counts(self) -> DataFrame:
        """One row of stage counts.  Rows read and rows passing the rules come
        from ONE pass over the raw input."""
        wide = self._bag(
            {
                "ingest": self.ingest_rows,
                "raw": self.raw_counts,
                "final": self.trips.agg(F.count(F.lit(1)).alias("final_cleaned_rows")),
                "daily": self.daily.agg(F.count(F.lit(1)).alias("daily_zone_agg_rows")),
                "hourly": self.hourly.agg(F.count(F.lit(1)).alias("hourly_profile_rows")),
            }
        )
        return wide.select(
            "ingest_total_rows",
            "raw_rows_read",
            (F.col("raw_rows_read") - F.col("valid_rows")).alias("invalid_rows_dropped"),
            (F.col("valid_rows") - F.col("final_cleaned_rows")).alias("duplicate_rows_dropped"),
            "final_cleaned_rows",
            "daily_zone_agg_rows",
            "hourly_profile_rows",
        )

    @cached_property
    def stage_counts(self) -> DataFrame:
        """``step_counts`` as ``(name, value)`` rows."""
        wide = self.step_counts
        return wide.unpivot([], wide.columns, "name", "value")

    @cached_property
    def raw_counts(self) -> DataFrame:
        """Rows read and rows valid, one pass over the raw input (one plan,
        so step counts and checks in the same query reuse its shuffle)."""
        return clean.raw_counts(self.raw, self.model)

    @cached_property
    def check_inputs(self) -> DataFrame:
        """The counts the checks take from outside the trip table; the final
        one is taken from the cleaning itself, not from the stored table."""
        raw = self.raw_counts.select("raw_rows_read")
        final = self.deduped.agg(F.count(F.lit(1)).alias("final_cleaned_rows"))
        return self._bag({"ingest": self.ingest_rows, "raw": raw, "final": final}).unpivot(
            [], ["ingest_total_rows", "raw_rows_read", "final_cleaned_rows"], "name", "value"
        )

    @cached_property
    def checks(self) -> DataFrame:
        return self.checks_of(quality.FAMILIES)

    def checks_of(self, families, counts: DataFrame | None = None) -> DataFrame:
        """Only the chosen check families (and only the counts they need);
        ``counts`` that the caller uses too are then made once."""
        return quality.run_checks(
            self.trips, self.daily, self.hourly, self.check_inputs if counts is None else counts, self.model,
            drift=self.drift, families=families,
        )

    @cached_property
    def drift(self) -> DataFrame:
        """Messages on the files of the drift source, one a missing column."""
        paths = self.source_paths(tables.DRIFT_TABLES)
        return drift.drift_messages(
            drift.drift_frame(self.spark, paths, tables.DRIFT_CANONICAL, tables.DRIFT_ALIASES)
        )

    # --- views ----------------------------------------------------------------
    @cached_property
    def kpis(self) -> DataFrame:
        return views.daily_kpis(self.daily)

    @cached_property
    def trend(self) -> DataFrame:
        return views.monthly_trend(self.daily)

    @cached_property
    def leaderboard(self) -> DataFrame:
        return views.zone_leaderboard(self.daily)

    @cached_property
    def demand(self) -> DataFrame:
        return views.hourly_demand(self.event_hourly)

    @cached_property
    def overlay(self) -> DataFrame:
        return views.anomaly_overlay(self.flags)

    def view_builders(self) -> dict:
        return {
            "vw_daily_kpis": lambda: self.kpis,
            "vw_monthly_trend": lambda: self.trend,
            "vw_zone_leaderboard": lambda: self.leaderboard,
            "vw_borough_share": lambda: views.borough_share(self.daily),
            "vw_hourly_demand": lambda: self.demand,
            "vw_anomaly_overlay": lambda: self.overlay,
            "vw_zone_weekly_cohort": lambda: views.zone_weekly_cohort(self.daily),
            "vw_data_quality": lambda: views.data_quality(self.checks),
        }

    def register_views(self, names=None) -> list[str]:
        """Create the curated temp views (all, or only ``names``)."""
        builders = self.view_builders()
        chosen = list(builders) if names is None else [n for n in builders if n in set(names)]
        for name in chosen:
            views.ordered(name, builders[name]()).createOrReplaceTempView(name)
        return chosen
