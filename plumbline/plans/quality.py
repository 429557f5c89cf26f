"""The whole run: profile, relate, check, compare, suggest, remediate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from plumbline.operators import drift, remediate, rules
from plumbline.plans import results
from plumbline.plans.checks import all_findings
from plumbline.plans.profile import Profile, profile
from plumbline.session import cut, pin
from plumbline.sources import snapshots


@dataclass
class Results:
    profile: Profile
    findings: DataFrame
    drift: DataFrame
    suggestions: DataFrame
    cleaned: Mapping[str, DataFrame]
    unknown_values: DataFrame
    history: str | None = None

    @cached_property
    def state(self) -> snapshots.State:
        """What is kept of this run to compare the next one with."""
        return snapshots.state(self.profile.tables, self.table_profile, self.column_profile)

    @cached_property
    def baseline_drift(self) -> DataFrame:
        """What changed since the latest run of the history: tables, columns, row counts, new
        values and numeric ranges. No rows without a history or a run in it."""
        return self.drift_since(snapshots.latest_state(self.profile.spark, self.history) if self.history else None)

    def drift_since(self, before: snapshots.State | None) -> DataFrame:
        if before is None:
            return self.profile.spark.createDataFrame([], drift.NO_DRIFT)
        return pin(drift.run_drift(before, self.state))  # a few rows per table and column

    @property
    def column_profile(self) -> DataFrame:
        return self.profile.columns

    @property
    def table_profile(self) -> DataFrame:
        return self.profile.table_profile

    @property
    def relationships(self) -> DataFrame:
        return self.profile.relationships

    @property
    def issues(self) -> DataFrame:
        return self.findings.where("NOT is_observation")

    @property
    def observations(self) -> DataFrame:
        return self.findings.where("is_observation")

    @property
    def data_dictionary(self) -> DataFrame:
        return results.data_dictionary(self.column_profile)

    @property
    def checklist(self) -> DataFrame:
        return results.checklist(self.findings, self.suggestions)

    @property
    def overview(self) -> DataFrame:
        return results.overview(self.findings)

    @property
    def to_remediate(self) -> DataFrame:
        return results.to_remediate(self.findings)

    @property
    def summary(self) -> DataFrame:
        """Rows and columns of every table, findings by severity, observations and drift events."""
        return results.run_summary(self.table_profile, self.findings, self.drift)

    @property
    def inventory(self) -> DataFrame:
        return results.checks_inventory(self.profile.spark, self.findings, self.drift)


def run_quality(
    tables: Mapping[str, DataFrame],
    config: Mapping | None = None,
    as_of: str | None = None,
    with_snippets: bool = True,
    with_additions: bool = False,
    integer_keys: bool = False,
    history: str | None = None,
) -> Results:
    """Run everything; dates after `as_of`, by default now, are future dates.

    `history` is the folder of earlier runs that `export` keeps; the latest is the baseline of
    `baseline_drift`. `integer_keys` lets whole numbers named like keys take part in relationships.
    Configuration: business_rules, expected_schema, primary_keys (all optional)."""
    config = config or {}
    as_of = as_of or datetime.now().isoformat(sep=" ", timespec="seconds")
    found = profile(tables, as_of, config.get("primary_keys"), integer_keys=integer_keys)
    configured = list(config.get("business_rules", []))
    unknown = rules.all_unknown_values(found.tables, configured)
    if rules.allowed_value_rules(found.tables, configured):
        unknown = cut(unknown)
    findings = all_findings(found, config, with_snippets, with_additions, unknown)
    expected = config.get("expected_schema", drift.K.EXPECTED_SCHEMA)
    events = drift.schema_drift(found.spark, drift.schema_of(found.tables), expected)
    return Results(
        profile=found,
        findings=findings,
        drift=events,
        suggestions=results.suggestions(findings),
        cleaned=remediate.remediate(found.tables, found.rows),
        unknown_values=unknown,
        history=history,
    )
