"""Daily sync: one business day of each table, as sorted row-keyed cells."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.cells import export_sorted, rows_to_cells, slice_by_day
from millrace.plans.freshness import feed_entries, merge_ledger


@dataclass(frozen=True)
class SyncSpec:
    """A table to sync. Without a date column every run takes the full table."""

    table: str
    keys: tuple[str, ...]
    date_column: str | None = None
    target: str | None = None

    @property
    def target_name(self) -> str:
        return self.target or self.table


# Table, key columns, date column of the five sync jobs.
SYNC_JOBS = {
    "asset_analysis": (
        SyncSpec("rt_cust_daily_return_rate", ("cptl_acc_id", "busi_date"), "busi_date"),
        SyncSpec("rt_cust_daily_stkreturn", ("cptl_acc_id", "busi_date", "stk_cd"), "busi_date"),
        SyncSpec("rt_cust_return_data", ("cptl_acc_id", "busi_date"), "busi_date"),
        SyncSpec("rt_cust_month_stk_return", ("cptl_acc_id",)),
        SyncSpec("rt_cust_stk_rank", ("cptl_acc_id", "stk_cd")),
    ),
    "asset_analysis2": (
        SyncSpec("rt_cust_pl_trdy", ("trd_date",)),
        SyncSpec("rt_cust_pl_payf_rate_trnd", ("cptl_id", "busi_date"), "busi_date"),
        SyncSpec("rt_cust_pl_payf_stat", ("cptl_id", "busi_date"), "busi_date"),
        SyncSpec("rt_cust_pl_mkt_indx_info", ("busi_date",), "busi_date"),
        SyncSpec("rt_cust_pl_payf_rate_stat", ("cptl_id", "stat_way")),
    ),
    "cleared_stock": (
        SyncSpec("rt_cust_cleared_stock", ("fund_id", "clear_date", "stk_cd", "market"), "clear_date"),
        SyncSpec("rt_cust_cleared_stock_detail",
                 ("fund_id", "stk_cd", "market", "clear_date", "trd_date", "trd_sno"), "clear_date"),
    ),
    "fund_mall": (
        SyncSpec("rt_fm_asset_return", ("fund_id", "fnd_cd")),
        SyncSpec("rt_fm_yest_return", ("fund_id", "fnd_cd", "busi_date"), "busi_date"),
    ),
    "cchr": (SyncSpec("c11", ("a0188",)),),
}


def sync_cells(df: DataFrame, spec: SyncSpec, day: str) -> DataFrame:
    """Cells of one table's slice, tagged with the target; narrow from scan to cells."""
    cells = slice_by_day(df, spec.date_column, day).transform(rows_to_cells, spec.keys)
    return cells.select(F.lit(spec.target_name).alias("target"), *cells.columns)


def daily_sync(load: Callable[[str], DataFrame], specs: Iterable[SyncSpec], day: str, out: str) -> list[str]:
    """Export every table to ``out/<target>/<day>`` and return the paths; each is its own Spark job."""
    paths = []
    for spec in specs:
        path = f"{out}/{spec.target_name}/day={'full' if day == '-1' else day}"
        cells = sync_cells(load(spec.table), spec, day).drop("target")
        export_sorted(cells, path)
        paths.append(path)
    return paths


def sync_and_record(load: Callable[[str], DataFrame], specs: Sequence[SyncSpec], day: str, out: str,
                    ledger: DataFrame, feed_time: Column) -> DataFrame:
    """Run the sync, then the freshness ledger with this run's entry for each target."""
    daily_sync(load, specs, day, out)
    names = ledger.sparkSession.createDataFrame([(s.target_name,) for s in specs], "name STRING")
    return merge_ledger(ledger, feed_entries(names, feed_time, F.lit(day)))
