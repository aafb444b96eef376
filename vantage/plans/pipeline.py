"""Layered pipeline: bronze (lazy views) -> silver (written) -> gold (written).

Silver and gold are materialisation barriers: each table is written once as
Parquet and read back, so every consumer (the next layer, the quality suite,
analyst queries) scans the stored table instead of recomputing its lineage,
and a lost executor only costs the tasks of the stage it was running.  Tables
go to ``root`` or, by default, to a fresh folder under the session's shared
checkpoint folder (``spark.checkpoint.dir``), each run to folders of its own;
``publish`` then switches the tables of a catalogue schema to them.

The feature table is stored by snapshot, so a reader of one snapshot reads one folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.pit import panel_size
from vantage.operators.quality import Check, Result, evaluate, gate, report, run_checks, write_checked
from vantage.plans.gold import fct_customer_return_risk_features, int_orders_enriched
from vantage.plans.silver import build_silver
from vantage.plans.suites import gold_suite, silver_suite
from vantage.session import scratch_root
from vantage.sinks.write import point_table

LAYERS = ("bronze", "silver", "gold")
#: column that a table is stored by
STORED_BY = {"fct_customer_return_risk_features": "snapshot_date"}
STORED_NEAR = {"fct_customer_return_risk_features": "trunc(snapshot_date, 'quarter')"}
#: rows of the feature table that a task makes and sorts (about 50 MB), and tasks at least
PANEL_ROWS, PANEL_TASKS = 250_000, 16


def staging_root(spark: SparkSession, name: str = "tables") -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@dataclass
class Record:
    """What a run wrote: results of its layers' suites, rows and folder of each table."""

    results: list[Result] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)


def stage(df: DataFrame, root: str, layer: str, name: str, checks: Sequence[Check] = (),
          record: Record | None = None, prefix: str = "", parts: int | None = None) -> DataFrame:
    """Write ``df`` to a new folder below ``root/layer/name`` (Parquet) and read it back: what an
    earlier run wrote stays for its readers.  Row-level ``checks`` on the table ride on the
    write.  ``parts``: as in ``write_checked``."""
    path = f"{root.rstrip('/')}/{layer}/{name}/run-{uuid.uuid4().hex[:12]}"
    out, rows, found = write_checked(df, path, [c for c in checks if c.table == name], STORED_BY.get(name),
                                     parts, STORED_NEAR.get(name))
    if record is not None:
        record.results += found
        record.rows[name], record.paths[name] = rows, path
    out.createOrReplaceTempView(f"{prefix}{layer}_{name}")
    return out


def stage_all(frames: dict[str, DataFrame], root: str, layer: str, threads: int = 4, checks: Sequence[Check] = (),
              record: Record | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """Materialise independent tables of one layer, up to ``threads`` Spark jobs
    at a time (the tables share no lineage, so their jobs can overlap)."""
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {n: pool.submit(stage, df, root, layer, n, checks, record, prefix) for n, df in frames.items()}
        return {n: f.result() for n, f in futures.items()}


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], root: str | None = None,
                 layers=LAYERS, lead: str = "1 month", fail_on: Sequence[str] = ("error", "warn"),
                 previous: dict[str, dict[str, DataFrame]] | None = None,
                 threads: int = 4, written=("silver", "gold"), record: Record | None = None,
                 publish: str | None = None, prefix: str = "") -> dict[str, dict[str, DataFrame]]:
    """Build the requested layers.  ``layers=("gold",)`` rebuilds gold only from
    the silver tables in ``previous``.  A layer's suite is checked as it is written (row-level
    checks) and on its written tables (keys): a failed check with a status in ``fail_on`` stops
    the run before the next layer (all checks must pass by default, whatever severity they
    declare; ``fail_on=()`` runs no gate).  Tables of one layer are written ``threads`` at a
    time, in dependency order across layers.

    ``written``: layers materialised as tables.  ``record`` takes what was written, and the
    results of the suites.  ``publish``: a schema whose tables are switched to the written
    ones after all gates; ``prefix``: of the temporary views' names, so that runs of one
    session can stay apart."""
    root = root or staging_root(spark)
    made = Record()
    out: dict[str, dict[str, DataFrame]] = {"bronze": raw}
    for name, df in raw.items():
        df.createOrReplaceTempView(f"{prefix}bronze_{name}")

    def run_suite(suite: list[Check], tables: dict[str, DataFrame]) -> list[Result]:
        return evaluate(suite, tables, done=[r for r in made.results if r.check in suite], threads=threads)

    beside = ThreadPoolExecutor(max_workers=2)
    later = []

    def checked(suite: list[Check], tables: dict[str, DataFrame]) -> None:
        """Before the next layer where a gate waits for the results, else beside it."""
        if fail_on:
            found = run_suite(suite, tables)
            if record is not None:
                record.results += found
            gate(report(spark, found), fail_on)
        elif record is not None:
            later.append(beside.submit(run_suite, suite, tables))

    if "silver" in layers and "silver" in written:
        out["silver"] = stage_all(build_silver(raw), root, "silver", threads, silver_suite(), made, prefix)
    elif "silver" in layers:
        out["silver"] = build_silver(raw)
    else:
        out["silver"] = (previous or {}).get("silver") or build_silver(raw)
    s = out["silver"]
    if "silver" in layers:
        checked(silver_suite(), {**raw, **s})
    if "gold" in layers:
        suite = gold_suite()
        enriched = stage(int_orders_enriched(s["stg_orders"], s["stg_order_payments"], s["stg_order_reviews"],
                                             s["stg_order_items"], s["stg_customers"], s["stg_geolocation"],
                                             raw["sellers"]), root, "gold", "int_orders_enriched", suite, made, prefix)
        of_orders = [c for c in suite if c.table == "int_orders_enriched"]
        if not fail_on:
            checked(of_orders, {"int_orders_enriched": enriched})
        customers = made.rows["stg_customers"] if "stg_customers" in made.rows else s["stg_customers"].count()
        most = panel_size(customers, enriched, "order_purchase_ts", "month")
        parts = max(PANEL_TASKS, -(-most // PANEL_ROWS))
        fct = stage(fct_customer_return_risk_features(enriched, lead, parts=parts), root, "gold",
                    "fct_customer_return_risk_features", suite, made, prefix, parts)
        out["gold"] = {"int_orders_enriched": enriched, "fct_customer_return_risk_features": fct}
        checked(suite if fail_on else [c for c in suite if c not in of_orders], {**raw, **s, **out["gold"]})
    for found in later:
        record.results += found.result()
    beside.shutdown()
    if record is not None:
        record.rows |= made.rows
        record.paths |= made.paths
    if publish is not None:
        tables = {n: df for layer in out.values() for n, df in layer.items()}
        for name, path in made.paths.items():
            point_table(spark, publish, name, path, tables[name].schema, by=STORED_BY.get(name))
    return out


def latest_rows(stored: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows of the last snapshot of a table stored by snapshot: its folder alone is read."""
    return stored.where(F.col(by) == stored.agg(F.max(by)).scalar())


def gold_report(tables: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Quality report of the gold layer (the enriched-order key check is an error)."""
    flat = {n: df for layer in tables.values() for n, df in layer.items()}
    return run_checks(gold_suite(), flat)
