"""The tables of one data folder, each built when first asked for and shared by the queries after it."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import domain, rawtext
from tidemark.params import SurveillanceParams
from tidemark.plans import daily, facts, funds, history, ingest, portfolio, quality, reference, screens, signals, triage, validation
from tidemark.session import checkpoint_dir
from tidemark.sources import bronze, store
from tidemark.sources.store import settle

DEFAULT = SurveillanceParams()
# Looser thresholds and lower bands, under which every rule and band occurs in the derived data.
RELAXED = SurveillanceParams(
    volume_spike_x=2.5, price_shock_pct=6.0, sector_calm_pct=4.0, pump_return_5d_pct=8.0, pump_volume_x=1.3,
    pump_low_delivery_ratio=0.9, circuit_tolerance=1.5, circuit_streak_days=2, high_score=50.0, medium_score=40.0)

_open: WeakKeyDictionary[SparkSession, dict[str, "Warehouse"]] = WeakKeyDictionary()


def model(build):
    """Written once per warehouse: later steps read its files instead of repeating its plan."""
    @wraps(build)
    def get(self, *args):
        key = (build.__name__, *args)
        if key not in self._built:
            self._built[key] = settle(build(self, *args), build.__name__)
        return self._built[key]
    return get


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._built: dict[tuple, DataFrame | str] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Warehouse":
        return _open.setdefault(spark, {}).setdefault(folder, cls(spark, folder))

    @staticmethod
    def forget(spark: SparkSession) -> None:
        """Build everything anew from here on; used by the bench."""
        _open.pop(spark, None)

    def source(self, make) -> DataFrame:
        return make(self.spark, self.folder)

    # ---------- dimensions and facts ----------

    @model
    def stock_master(self) -> DataFrame:
        """The snapshots, few rows out of all orders: histories read them more than once."""
        return self.source(domain.stock_master)

    @model
    def stocks(self) -> DataFrame:
        return reference.dim_stock(self.stock_master())

    @model
    def fact(self) -> DataFrame:
        return facts.stock_daily(self.source(domain.bars), self.stocks())

    def taken_by_day(self, p: SurveillanceParams, days: int = 2) -> str:
        """Facts and signals whose last days came one at a time: the folder they are stored in."""
        if ("taken_by_day", p) not in self._built:
            path = f"{checkpoint_dir(self.spark)}/by-day-{uuid.uuid4().hex}"
            prices = settle(self.source(domain.bars), "bars")
            last = [r[0] for r in prices.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(days).collect()]
            daily.take(prices.where(F.col("trade_date") < F.lit(last[-1])), self.stocks(), path, p)
            for day in reversed(last):
                daily.take(prices.where(F.col("trade_date") == F.lit(day)), self.stocks(), path, p)
            self._built["taken_by_day", p] = path
        return self._built["taken_by_day", p]

    @model
    def filings(self) -> DataFrame:
        return reference.staged_announcements(self.source(domain.announcements))

    @model
    def lists(self) -> DataFrame:
        return reference.staged_lists(self.source(domain.surveillance_lists))

    @model
    def actions(self) -> DataFrame:
        return reference.staged_actions(self.source(domain.corporate_actions))

    @model
    def staged_nav(self) -> DataFrame:
        return self.source(domain.staged_nav)

    @model
    def fund_nav(self) -> DataFrame:
        return facts.fund_nav(self.staged_nav())

    @model
    def funds(self) -> DataFrame:
        return reference.dim_fund(self.staged_nav())

    @model
    def fund_performance(self) -> DataFrame:
        return funds.performance(self.fund_nav(), self.funds())

    @model
    def indices(self) -> DataFrame:
        return reference.staged_indices(self.source(domain.index_daily))

    @model
    def holidays(self) -> DataFrame:
        return self.source(domain.holidays)

    @model
    def raw_prices(self) -> DataFrame:
        """The text rows as they would lie in the raw files."""
        return self.source(rawtext.price_rows)

    @model
    def typed_prices(self) -> DataFrame:
        """Parsed once: a filter on parsed columns would be pushed below the parsing and repeat it."""
        return bronze.typed_prices(self.raw_prices())

    def lake(self, table: str) -> str:
        """The folder of a lake in which one table was built from files: rows written in the source's layout, then
        ingested in steps, the last of which repeats, corrects or comes late.
        """
        if ("lake", table) not in self._built:
            root = f"{checkpoint_dir(self.spark)}/files-{uuid.uuid4().hex}"
            self._build_lake(table, f"{root}/raw", f"{root}/lake")
            self._built["lake", table] = f"{root}/lake"
        return self._built["lake", table]

    def _build_lake(self, table: str, raw: str, lake: str) -> None:
        spark, early, late = self.spark, dt.date(1997, 1, 1), dt.date(1995, 1, 1)
        first = [d for d in rawtext.quarters() if d < early and d != late]
        steps = [first, [d for d in rawtext.quarters() if d >= early], [late], first[-2:]]
        if table == "stock_daily":
            rawtext.write_price_files(self.raw_prices(), raw)
            for days in (None, [rawtext.AGAIN]):
                ingest.build_stock_daily(spark, raw, lake, days)
        elif table == "index_daily":
            rawtext.write_index_files(self.source(domain.index_daily), raw)
            for days in (None, [rawtext.AGAIN]):
                ingest.build_index_daily(spark, raw, lake, days)
        elif table == "announcements":
            rawtext.write_filings(self.source(domain.announcements), raw)
            for days in steps:
                ingest.build_announcements(spark, raw, lake, days)
        elif table == "corporate_actions":
            rawtext.write_actions(self.source(domain.action_filings), raw)
            for days in steps:
                ingest.build_corporate_actions(spark, raw, lake, days)
        elif table == "fund_nav":
            rawtext.write_nav_files(self.source(rawtext.nav_lines), raw)
            for days in (None, [dt.date(1998, 12, 31)]):
                ingest.build_fund_nav(spark, raw, lake, days)
        elif table == "fund_nav_history":
            rawtext.write_history(self.source(domain.fund_nav_history), raw)
            ingest.build_fund_nav_history(spark, raw, lake)
        elif table == "stock_master":
            listed = self.source(domain.nations).where("n_nationkey % 2 = 1")
            rawtext.write_master(self.stock_master(), listed, raw)
            for days in steps:
                ingest.build_stock_master(spark, raw, lake, days)

    def lake_table(self, table: str, name: str | None = None) -> DataFrame:
        """A table as it lies on disk, without the columns of the storage."""
        stored = store.read_table(self.spark, f"{self.lake(table)}/{name or table}")
        return stored.drop(*[c for c in stored.columns if c in ("month", "_ingested_at", "_landed")])

    @model
    def merged_versions(self) -> DataFrame:
        """History of instruments merged from the snapshots in batches, the first of them single snapshots."""
        path = f"{checkpoint_dir(self.spark)}/history-{uuid.uuid4().hex}/stock_versions"
        master = self.stock_master()
        days = sorted(r[0] for r in master.select("snapshot_date").distinct().collect())        # one row per snapshot
        for batch in (days[:1], days[1:2], days[2:9], days[9:], days[-1:]):
            if batch:
                history.merge_snapshots(master.where(F.col("snapshot_date").isin(batch)), path)
        return history.versions(self.spark, path)

    # ---------- surveillance ----------

    @model
    def measures(self, p: SurveillanceParams) -> DataFrame:
        return signals.measured(self.fact(), self.stocks(), p)

    def signals(self, p: SurveillanceParams) -> DataFrame:
        loose = SurveillanceParams(**{**p.__dict__, "baseline": "flat"})    # measures do not depend on the baseline
        return signals.flagged(self.measures(loose), p)

    @model
    def alerts(self, p: SurveillanceParams) -> DataFrame:
        return signals.alerts(self.signals(p), self.filings(), p)

    @model
    def outcomes(self, p: SurveillanceParams) -> DataFrame:
        return validation.outcomes(self.signals(p), self.alerts(p), self.filings(), self.lists())

    @model
    def validated(self, p: SurveillanceParams) -> DataFrame:
        return validation.validation(self.outcomes(p))

    @model
    def events(self, p: SurveillanceParams) -> DataFrame:
        return validation.event_study(self.alerts(p), self.fact())

    @model
    def triage(self, p: SurveillanceParams) -> DataFrame:
        return triage.triage_with_replies(self.alerts(p), self.replies(p), "m1")

    def replies(self, p: SurveillanceParams) -> DataFrame:
        """Stored replies in every shape that occurs, usable and not, spread over the alerts."""
        kind = F.pmod(F.col("date_key"), F.lit(6))
        long_line = F.concat(F.lit("Results of "), F.repeat(F.col("symbol"), 20))
        reply = (F.when(kind == 0, F.concat(F.lit('```json\n{"verdict": "explained", "line": "Results of '),
                                            F.col("symbol"), F.lit('"}\n```')))
                 .when(kind == 1, F.lit('{"verdict": "MAYBE", "line": "not a verdict"}'))
                 .when(kind == 2, F.lit('{"verdict": "UNEXPLAINED", "line": "  spaced   out \\n line "}'))
                 .when(kind == 3, F.lit("the service is busy"))
                 .when(kind == 4, F.concat(F.lit('{"verdict": "Unclear", "line": "'), long_line, F.lit('"}')))
                 .otherwise(F.lit('{"verdict": "EXPLAINED", "line": " "}')))
        return self.alerts(p).select("alert_id", reply.alias("reply"))

    @model
    def stock_checks(self, p: SurveillanceParams) -> DataFrame:
        return screens.stock_checks(self.fact(), self.alerts(p), self.triage(p), self.filings(), self.lists())

    @model
    def stock_levels(self, p: SurveillanceParams) -> DataFrame:
        return screens.stock_levels(self.stock_checks(p), self.fact())

    @model
    def directory(self) -> DataFrame:
        return reference.symbol_directory(self.fact(), self.stocks())

    # ---------- portfolio ----------

    @model
    def staged_txns(self) -> DataFrame:
        return facts.staged_transactions(self.source(domain.portfolio))

    @model
    def txns(self) -> DataFrame:
        return facts.portfolio_transactions(self.staged_txns(), self.staged_nav())

    @model
    def holdings(self) -> DataFrame:
        return portfolio.holdings(self.txns(), self.fact(), self.fund_nav(), self.stocks(), self.funds())

    # ---------- operations ----------

    @model
    def daily_checks(self) -> DataFrame:
        """The row-count check of every day, in the shape the digest reads."""
        return quality.daily_row_counts(self.fact()).select(
            F.col("trade_date").alias("run_date"), F.lit("row_count_vs_20d_avg").alias("check_name"), "status")

    def runs(self) -> DataFrame:
        return self.source(domain.pipeline_runs)
