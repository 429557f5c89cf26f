"""Write everything a run produced, and keep a snapshot of what it loaded."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from plumbline.plans.quality import Results
from plumbline.session import pin
from plumbline.sources import sinks, snapshots


def export(
    run: Results, config: Mapping, folder: str, run_id: str | None = None
) -> tuple[list[str], DataFrame]:
    """Cleaned tables, findings, checklist, suggestions, dictionary, drift, what changed since the
    run before this one, and the state of this one. The former state is read before the new one is
    added, and the new one counts as a run only when all of it is written.

    Returns the paths and the information on the run before this one."""
    spark = run.profile.spark
    sources = config.get("sources", {})
    now = datetime.now()
    history = f"{folder}/snapshots"
    baseline = snapshots.latest_state(spark, history)
    rows = baseline.tables if baseline else spark.createDataFrame([], snapshots.SCHEMA)
    before = pin(snapshots.baseline_info(rows))  # at most one row
    paths = sinks.write_cleaned(run.cleaned, sources, folder)
    sinks.write_results(run.findings, f"{folder}/findings")
    paths.append(f"{folder}/findings")
    for name, df in {
        "checklist": run.checklist,
        "suggestions": run.suggestions,
        "data_dictionary": run.data_dictionary,
        "checks_inventory": run.inventory,
        "relationships": run.relationships,
        "drift": run.drift,
        "baseline_drift": run.drift_since(baseline),
        "unknown_values": run.unknown_values,
        "summary": run.summary,
        "overview": run.overview,
        "to_remediate": run.to_remediate,
        "table_profile": run.table_profile,
        "column_profile": run.column_profile,
    }.items():
        sinks.write_table(df, f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    files = {name: str(source["file"]) for name, source in sources.items() if source.get("file")}
    rows = snapshots.snapshot(
        run.table_profile,
        files,
        run_id or now.strftime("%Y%m%dT%H%M%S%f"),
        now.strftime("%Y-%m-%d %H:%M:%S"),
    )
    snapshots.append(rows, history, run.state.columns, run.state.values)
    paths.append(history)
    return paths, before
