"""Run identity and pipeline settings, passed explicitly to every operator that needs them."""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunContext:
    """Values fixed once per run, so that a retried task writes the same bytes."""

    run_id: str
    run_ts: dt.datetime
    as_of: dt.date
    job_name: str = "orderflow"

    @classmethod
    def new(cls, job_name: str = "orderflow", as_of: dt.date | None = None) -> RunContext:
        now = dt.datetime.now(dt.timezone.utc)
        return cls(str(uuid.uuid4()), now, as_of or now.date(), job_name)

    @property
    def stamp(self) -> str:
        """Run time as it appears in output paths."""
        return self.run_ts.strftime("%Y%m%dT%H%M%SZ")


@dataclass(frozen=True)
class PipelineConfig:
    """Where a pipeline reads and writes, and its thresholds."""

    source_root: str
    staging_root: str
    manifest_root: str
    target_root: str
    export_root: str
    audit_root: str
    rejected_root: str
    table: str = "fact_orders"
    source_format: str = "auto"
    partition_date: dt.date | None = None
    lookback_days: int = 1
    max_reject_pct: float = 5.0
    sla_days: int = 7
    summary_days: int = 90
    keys: Sequence[str] = field(default=("order_id",))
    write_rejects_on_abort: bool = False
    multi_line: bool | None = None
    customers_path: str | None = None
    products_path: str | None = None

    @classmethod
    def under(cls, source_root: str, work_root: str, **settings) -> PipelineConfig:
        """All outputs below one root directory."""
        return cls(
            source_root=source_root,
            staging_root=f"{work_root}/processed",
            manifest_root=f"{work_root}/manifests",
            target_root=f"{work_root}/warehouse",
            export_root=f"{work_root}/summaries",
            audit_root=f"{work_root}/etl_audit_log",
            rejected_root=f"{work_root}/rejected",
            **settings,
        )

    @classmethod
    def from_args(cls, argv: Sequence[str]) -> PipelineConfig:
        p = argparse.ArgumentParser(prog="orderflow")
        for name in ("source-root", "staging-root", "manifest-root", "target-root",
                     "export-root", "audit-root", "rejected-root"):
            p.add_argument(f"--{name}", required=True)
        p.add_argument("--table", default="fact_orders")
        p.add_argument("--source-format", choices=("auto", "parquet", "csv", "typed"), default="auto")
        p.add_argument("--partition-date", type=dt.date.fromisoformat)
        p.add_argument("--lookback-days", type=int, default=1)
        p.add_argument("--max-reject-pct", type=float, default=5.0)
        p.add_argument("--sla-days", type=int, default=7)
        p.add_argument("--summary-days", type=int, default=90)
        p.add_argument("--keys", type=lambda text: tuple(text.split(",")), default=("order_id",))
        p.add_argument("--customers-path", help="Parquet of the customer dimension")
        p.add_argument("--products-path", help="Parquet of the product dimension")
        p.add_argument("--single-line-csv", dest="multi_line", action="store_const", const=False, help="no CSV field holds a line break")
        p.add_argument("--multi-line-csv", dest="multi_line", action="store_const", const=True, help="some do; otherwise files are looked through")
        p.add_argument("--write-rejects-on-abort", action="store_true")
        return cls(**vars(p.parse_args(argv)))
