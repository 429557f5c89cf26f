"""Result tables derived from profiles and findings; all inputs are schema-sized."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.plans.profile import local


def _in_order(*keys) -> Window:
    return Window.partitionBy(F.lit(1)).orderBy(*keys)


def severity_counts(findings: DataFrame, drift: DataFrame | None = None) -> DataFrame:
    """Issues per severity, observations and drift events as one row."""
    counts = findings.selectExpr(
        *[
            f"count_if(NOT is_observation AND severity = '{s}') AS `{s.lower()}`"
            for s in K.SEVERITY_RANK
        ],
        "count_if(is_observation) AS observations",
        "count_if(NOT is_observation AND severity IN ('HIGH', 'MEDIUM')) AS to_remediate",
    )
    if drift is None:
        return counts
    one = F.lit(1).alias("one")
    events = drift.agg(F.count(F.lit(1)).alias("drift")).select("*", one)
    return counts.select("*", one).join(events, "one").drop("one")


def run_summary(table_profile: DataFrame, findings: DataFrame, drift: DataFrame) -> DataFrame:
    """What a run has seen, one number per row: rows and columns of each table, issues by severity,
    observations, findings to remediate and drift events."""
    sizes = table_profile.selectExpr(
        "'table' AS section", "`table` AS name",
        "stack(2, 'rows', CAST(row_count AS BIGINT), 'columns', CAST(col_count AS BIGINT)) AS (measure, value)",
    )
    counts = severity_counts(findings, drift)
    cells = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in counts.columns)
    totals = counts.selectExpr(
        "'findings' AS section", "'all' AS name",
        f"stack({len(counts.columns)}, {cells}) AS (measure, value)",
    )
    return sizes.unionByName(totals)


def to_remediate(findings: DataFrame) -> DataFrame:
    """The issues that call for a remediation, with what to do."""
    return findings.where("NOT is_observation AND severity IN ('HIGH', 'MEDIUM')").select(
        "ordinal", "severity", "table", "column", "suggestion"
    )


def overview(findings: DataFrame) -> DataFrame:
    """Issues, then observations, with the suggestion cut for display."""
    limit = K.OVERVIEW_SUGGESTION_CHARS
    short = F.when(
        F.length("suggestion") > limit,
        F.concat(F.substring("suggestion", 1, limit), F.lit("…")),
    ).otherwise(F.col("suggestion"))
    return findings.select(
        "ordinal",
        F.when(F.col("is_observation"), "OBS").otherwise(F.col("severity")).alias("label"),
        "category",
        F.concat_ws(".", "table", "column").alias("location"),
        "description",
        short.alias("suggestion"),
    )


def _hint() -> str:
    """What to do about a finding in Spark, by category."""
    return """
    CASE
      WHEN category = 'REFERENTIAL'
        THEN concat('split_mapped(', `table`, ', reference, [''', coalesce(`column`, ''), ''']): keep the mapped rows, log the others')
      WHEN category = 'COMPLETENESS' AND `column` IS NOT NULL
        THEN concat('forward_fill(', `table`, ', date, [''', `column`, ''']) if the table is a series')
      WHEN category = 'INTEGRITY' AND lower(description) LIKE '%duplicate%'
        THEN concat('keep_latest or flag_duplicates on [', coalesce(`column`, 'all columns'), ']')
      WHEN category = 'OUTLIER'
        THEN concat('flag_outliers(', `table`, ', [', `column`, ']); average over rows flagged OK')
      WHEN category = 'TEMPORAL'
        THEN concat('mark_reference_data on [', coalesce(`column`, ''), ']; show rows without reference data apart')
      WHEN category = 'STRUCTURE'
        THEN concat('do not load ', `table`, ' before its columns are confirmed')
      ELSE suggestion
    END
    """


def suggestions(findings: DataFrame) -> DataFrame:
    """The first issue per category, table and column as a task with priority and hint.

    Ids follow the place of the issue among all issues."""
    first = Window.partitionBy("category", "table", "column").orderBy("number")
    return (
        findings.where(~F.col("is_observation"))
        .withColumn("number", F.row_number().over(_in_order("ordinal")))
        .withColumn("place", F.row_number().over(first))
        .where("place = 1")
        .select(
            F.concat(
                F.lit("S-"),
                F.when(F.col("number") < 1000, F.lpad(F.col("number").cast("string"), 3, "0"))
                .otherwise(F.col("number").cast("string")),
            ).alias("id"),
            F.expr(
                "CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END"
            ).alias("priority"),
            "severity",
            "category",
            "table",
            F.col("affected").alias("affected_rows"),
            "description",
            F.col("suggestion").alias("action"),
            F.expr(_hint()).alias("hint"),
            "number",
        )
        .orderBy("priority", "number")
        .drop("number")
    )


def checklist(findings: DataFrame, tasks: DataFrame) -> DataFrame:
    """Issues numbered for working off, with the hint of the task of the same description."""
    last = Window.partitionBy("description").orderBy(F.desc("id"))
    hints = (
        tasks.withColumn("place", F.row_number().over(last))
        .where("place = 1")
        .select("description", "hint")
    )
    return (
        findings.where(~F.col("is_observation"))
        .withColumn("number", F.row_number().over(_in_order("ordinal")))
        .join(hints, "description", "left")
        .select(
            "number",
            F.lit("Open").alias("status"),
            "severity",
            "category",
            "table",
            F.coalesce("column", F.lit("—")).alias("column"),
            F.col("description").alias("issue"),
            "suggestion",
            F.coalesce("hint", F.lit("")).alias("hint"),
        )
        .orderBy("number")
    )


def checks_inventory(
    spark: SparkSession, findings: DataFrame, drift: DataFrame | None = None
) -> DataFrame:
    """The registry of checks with what was found in the category of each."""
    registry = local(
        spark,
        [{"check_id": i, "name": n, "category": c} for i, n, c in K.CHECK_REGISTRY],
        "check_id string, name string, category string",
    )
    found = findings.groupBy("category").agg(
        F.count(F.lit(1)).alias("found"),
        F.min_by("severity", "ordinal").alias("severity"),
        F.min_by("is_observation", "ordinal").alias("only_observed"),
    )
    if drift is not None:
        events = drift.agg(F.count(F.lit(1)).alias("found")).where("found > 0").select(
            F.lit("GOVERNANCE").alias("category"),
            "found",
            F.lit("HIGH").alias("severity"),
            F.lit(False).alias("only_observed"),
        )
        found = found.unionByName(events)
    status = F.expr(
        "CASE WHEN found IS NULL THEN 'clean' WHEN only_observed THEN 'obs' ELSE lower(severity) END"
    )
    return registry.join(found, "category", "left").select(
        "check_id",
        "name",
        "category",
        F.coalesce("found", F.lit(0)).cast("bigint").alias("found"),
        status.alias("status"),
    )


def data_dictionary(columns: DataFrame) -> DataFrame:
    """One row per column: type, nulls, distinct values, range, samples and notes."""
    return columns.selectExpr(
        "`table`",
        "`column`",
        "inferred_type",
        "CASE WHEN null_count > 0 THEN 'Yes' ELSE 'No' END AS nullable",
        "concat(format_number(null_pct, 1), '%') AS null_pct",
        "unique_count",
        "concat(format_number(unique_pct, 1), '%') AS unique_pct",
        """coalesce(CASE inferred_type WHEN 'numeric' THEN format_number(num_min, 4)
             WHEN 'date' THEN date_format(date_min, 'yyyy-MM-dd') END, '—') AS min_value""",
        """coalesce(CASE inferred_type WHEN 'numeric' THEN format_number(num_max, 4)
             WHEN 'date' THEN date_format(date_max, 'yyyy-MM-dd') END, '—') AS max_value""",
        f"array_join(slice(sample_values, 1, {K.DICTIONARY_SAMPLES}), ', ') AS samples",
        """concat_ws('; ',
             CASE WHEN is_likely_pk THEN 'inferred PK' END,
             CASE WHEN is_likely_fk THEN 'inferred FK' END,
             CASE WHEN outlier_count > 0 THEN concat(outlier_count, ' outlier(s)') END,
             CASE WHEN cardinality_flag = 'HIGH' THEN 'high cardinality' END,
             CASE WHEN has_negatives AND inferred_type = 'numeric' THEN 'contains negatives' END
           ) AS notes""",
    )


def dictionary_metadata(columns: DataFrame) -> DataFrame:
    return columns.agg(
        F.count_distinct("table").alias("tables"), F.count(F.lit(1)).alias("total_columns")
    )


def source_inventory(tables: DataFrame, sources: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Table, source, rows, columns and the first column names."""
    source = F.col("table")
    for name, entry in (sources or {}).items():
        if entry.get("file"):
            source = F.when(
                F.col("table") == name, F.lit(str(entry["file"]).rsplit("/", 1)[-1])
            ).otherwise(source)
    shown = F.array_join(F.slice("columns", 1, K.INVENTORY_COLUMNS), ", ")
    more = F.when(F.size("columns") > K.INVENTORY_COLUMNS, F.lit(" …")).otherwise("")
    return tables.select(
        "table",
        source.alias("source"),
        "row_count",
        "col_count",
        F.concat(shown, more).alias("first_columns"),
    )


def totals(tables: DataFrame) -> DataFrame:
    return tables.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("row_count").alias("total_rows"),
        F.sum("col_count").alias("total_columns"),
    )
