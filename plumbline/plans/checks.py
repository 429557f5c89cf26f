"""Findings: every check is a filter and projection over schema-sized profile tables."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import literal, quoted
from plumbline.operators import duplicates, relate, rules, snippets, temporal
from plumbline.plans.profile import Profile, local
from plumbline.schemas import FINDINGS
from plumbline.session import cut, together, union_all

# fixed values: stages in which findings arise, in order
TABLES, REFERENCES, COVERAGE, ISOLATION, RULES = range(5)

DEFAULTS = {
    "severity": "'LOW'",
    "column": "`column`",
    "affected": "0",
    "examples": "CAST(array() AS array<string>)",
    "suggestion": "''",
    "is_observation": "false",
    "explanation": "''",
    "stats": "CAST(map() AS map<string,string>)",
    "stage": str(TABLES),
    "place": "array(table_position, position)",
    "snippet": "CAST(NULL AS string)",
    "snippet_flag": "''",
}
TYPES = {
    "affected": "bigint", "column": "string", "place": "array<int>", "stats": "map<string,string>",
}


def finding(
    rows: DataFrame, check_id: str, step: int, category: str, where: str = "true", /, **parts: str
) -> DataFrame:
    """Turn the rows that meet a condition into findings; the parts are SQL expressions."""
    fixed = {"check_id": literal(check_id), "category": literal(category), "step": str(step)}
    exprs = DEFAULTS | fixed | parts
    return rows.where(where).selectExpr(
        "`table`",
        *[
            f"CAST({e} AS {TYPES[n]}) AS `{n}`" if n in TYPES else f"{e} AS `{n}`"
            for n, e in exprs.items()
        ],
    )


PLACEHOLDER = re.compile(r"\{(\w+)(?::(\d))?\}")


def worded(template: str) -> str:
    """A template as a SQL expression: {x} is a column, {x:2} a number with two decimals."""
    parts, end = [], 0
    for match in PLACEHOLDER.finditer(template):
        name, digits = match.groups()
        value = f"`{name}`"
        if digits:
            value = f"format_number({value}, {digits})"
        elif name in ("date_min", "date_max"):
            value = f"date_format({value}, 'yyyy-MM-dd')"
        parts += [literal(template[end : match.start()]), value]
        end = match.end()
    parts.append(literal(template[end:]))
    return f"concat({', '.join(parts)})"


def text(name: str) -> str:
    return worded(K.FINDING_TEXT[name])


def stats(name: str) -> str:
    pairs = [
        f"{literal(label)}, {worded(value)}"
        for label, value in K.FINDING_STATISTICS[name].items()
    ]
    return f"map({', '.join(pairs)})"


def _flow() -> str:
    return "(" + " OR ".join(f"contains(lower(`column`), '{w}')" for w in K.FLOW_NAMES) + ")"


def _positive() -> str:
    return "(" + " OR ".join(f"contains(lower(`column`), '{w}')" for w in K.POSITIVE_NAMES) + ")"


# ---- table level ------------------------------------------------------------------


def empty_rows(tables: DataFrame) -> DataFrame:
    return finding(
        tables, "CHK-04", 0, "COMPLETENESS", "fully_empty_rows > 0",
        severity="'HIGH'", column="NULL", place="array(table_position, -1)",
        description=text("empty_rows"),
        affected="fully_empty_rows",
        suggestion="'Drop the rows in which every column is null.'",
        explanation="concat(fully_empty_rows, ' of ', row_count, ' rows in [', `table`, '] have no value in any column.')",
        stats=stats("empty_rows"),
        snippet="'empty'", snippet_flag="'EMPTY ROW'",
    )


def duplicate_rows(tables: DataFrame) -> DataFrame:
    return finding(
        tables, "CHK-05", 1, "INTEGRITY", "duplicate_rows > 0",
        severity="'MEDIUM'", column="NULL", place="array(table_position, -1)",
        description=text("duplicate_rows"),
        affected="duplicate_rows",
        suggestion="'Keep one copy of each row (dropDuplicates).'",
        explanation="concat(duplicate_rows, ' rows in [', `table`, '] repeat another row in every column and would be counted twice in sums.')",
        stats=stats("duplicate_rows"),
        snippet="'duplicates'", snippet_flag="'DUPLICATE'",
    )


def duplicate_keys(tables: DataFrame) -> DataFrame:
    return finding(
        tables, "CHK-06", 2, "INTEGRITY",
        f"likely_pk IS NOT NULL AND duplicate_pk_rows > 0 AND row_count >= {K.MIN_ROWS_DUPLICATE_KEY}",
        severity="'HIGH'", column="likely_pk", place="array(table_position, -1)",
        description=text("duplicate_keys"),
        affected="duplicate_pk_rows",
        suggestion="concat('Check repeated [', likely_pk, '] values; suffixes such as -01 and -02 may be versions of one code.')",
        explanation="concat('[', likely_pk, '] identifies the rows of [', `table`, '], yet ', duplicate_pk_rows, ' rows share a value; joins on it would multiply rows.')",
        stats=stats("duplicate_keys"),
        snippet="'keys'", snippet_flag="'DUPLICATE KEY'",
    )


# ---- column level -----------------------------------------------------------------


def nulls(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-01", 3, "COMPLETENESS", "null_count > 0",
        check_id="CASE WHEN is_likely_pk THEN 'CHK-01' WHEN is_likely_fk THEN 'CHK-02' ELSE 'CHK-03' END",
        severity="CASE WHEN is_likely_pk THEN 'HIGH' WHEN is_likely_fk THEN 'MEDIUM' ELSE 'LOW' END",
        description=text("nulls"),
        affected="null_count",
        suggestion="""CASE
            WHEN inferred_type = 'date' THEN concat('Fill [', `column`, '] forward if it is a series; otherwise ask the source.')
            WHEN inferred_type = 'numeric' THEN concat('Impute [', `column`, '] by its median or mark it as missing; zero would be wrong.')
            WHEN is_likely_pk THEN concat('Key [', `column`, '] must be complete; ask the source now.')
            WHEN is_likely_fk THEN concat('Rows without [', `column`, '] will not join and drop out of reports.')
            ELSE concat('Find out whether nulls in [', `column`, '] are expected.') END""",
        explanation="concat(null_count, ' of ', row_count, ' rows in [', `table`, '] have no value in [', `column`, '].')",
        stats=stats("nulls"),
        snippet="'null'", snippet_flag="'NULL'",
    )


def outliers(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-11", 4, "OUTLIER", "inferred_type = 'numeric' AND outlier_count > 0",
        check_id=f"CASE WHEN {_flow()} THEN 'CHK-16' ELSE 'CHK-11' END",
        severity=f"CASE WHEN NOT {_flow()} AND outlier_count / greatest(row_count, 1) > {K.OUTLIER_MEDIUM_SHARE} THEN 'MEDIUM' ELSE 'LOW' END",
        is_observation=_flow(),
        description=text("outliers"),
        affected="outlier_count",
        suggestion=f"CASE WHEN {_flow()} THEN concat('Look for offsetting pairs among the large [', `column`, '] values; keep them in sums.') ELSE concat('Flag outliers of [', `column`, '] in a column of their own and leave flagged rows out of averages.') END",
        explanation=f"concat('Half of the [', `column`, '] values lie between ', format_number(num_q1, 2), ' and ', format_number(num_q3, 2), '; ', outlier_count, ' lie outside the fence.', CASE WHEN {_flow()} THEN ' Large flows are normal in a trading book.' ELSE '' END)",
        stats=stats("outliers"),
        snippet="'outlier'", snippet_flag="'OUTLIER'",
    )


def negatives(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-12", 5, "INTEGRITY",
        f"inferred_type = 'numeric' AND has_negatives AND NOT {_flow()} AND {_positive()}",
        severity="'MEDIUM'",
        description=text("negatives"),
        affected="negative_count",
        suggestion="concat('Confirm and document the sign convention of [', `column`, '].')",
        explanation="concat('The name of [', `column`, '] suggests values of zero or more; ', negative_count, ' are below.')",
        stats=stats("negatives"),
        snippet="'negative'", snippet_flag="'NEGATIVE'",
    )


def unparsed_dates(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-D1", 6, "COMPLETENESS", "inferred_type = 'date' AND date_parse_fail > 0",
        severity="'HIGH'",
        description=text("unparsed_dates"),
        affected="date_parse_fail",
        suggestion="concat('Deliver [', `column`, '] as YYYY-MM-DD.')",
        explanation="concat(date_parse_fail, ' values of [', `column`, '] are no dates in a known form and are lost to date logic.')",
        stats=stats("unparsed_dates"),
    )


def future_dates(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-D2", 7, "INTEGRITY", "inferred_type = 'date' AND date_future > 0",
        severity="'MEDIUM'",
        description=text("future_dates"),
        affected="date_future",
        suggestion="concat('Check [', `column`, ']: dates after today may be entry errors.')",
        explanation="concat(date_future, ' rows have a date in [', `column`, '] after the as-of date.')",
        stats=stats("future_dates"),
        snippet="'future'", snippet_flag="'FUTURE DATE'",
    )


def date_gaps(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-15", 8, "TEMPORAL",
        f"inferred_type = 'date' AND date_gaps > {K.MAX_UNREPORTED_GAPS}",
        description=text("date_gaps"),
        affected="date_gaps",
        suggestion="concat('Check whether the days missing from [', `column`, '] are intended.')",
        explanation="concat('Weekends aside, the sequence of [', `column`, '] is interrupted ', date_gaps, ' times.')",
        stats=stats("date_gaps"),
    )


def mixed_types(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-10", 9, "STRUCTURE", "has_mixed_types",
        severity="'HIGH'",
        description=text("mixed_types"),
        suggestion="concat('Set the type of [', `column`, '] and turn other values into nulls.')",
        explanation="concat('[', `column`, '] is mostly ', inferred_type, ', but some values do not convert.')",
        stats=stats("mixed_types"),
    )


def high_cardinality(columns: DataFrame) -> DataFrame:
    return finding(
        columns, "CHK-07", 10, "INTEGRITY",
        "cardinality_flag = 'HIGH' AND inferred_type = 'categorical' AND NOT is_likely_pk",
        description=text("high_cardinality"),
        suggestion="concat('Move [', `column`, '] to a lookup table if its values repeat.')",
        explanation="concat('[', `column`, '] has ', unique_count, ' distinct values in ', row_count, ' rows; a category should have few.')",
        stats=stats("high_cardinality"),
    )


def encoding(columns: DataFrame) -> DataFrame:
    """Advertised by the registry: the flag as a finding."""
    return finding(
        columns, "X8", 11, "STRUCTURE", "has_encoding_issues",
        severity="'HIGH'",
        description="concat(encoding_count, ' value(s) in [', `column`, '] contain control or replacement characters')",
        affected="encoding_count",
        suggestion="concat('Deliver [', `column`, '] as clean UTF-8.')",
        explanation="concat('Control characters in [', `column`, '] break exact joins and imports.')",
        stats="map('Values', CAST(encoding_count AS STRING))",
        snippet="'encoding'", snippet_flag="'ENCODING'",
    )


COLUMN_CHECKS = (
    nulls, outliers, negatives, unparsed_dates, future_dates, date_gaps, mixed_types,
    high_cardinality,
)
TABLE_CHECKS = (empty_rows, duplicate_rows, duplicate_keys)


# ---- across tables ----------------------------------------------------------------


def orphans(relations: DataFrame, members: DataFrame) -> DataFrame:
    reported = relate.checked(relations).join(
        relate.orphan_examples(members, relations), ["from_key", "to_key"], "left"
    )
    rows = reported.selectExpr("from_table AS `table`", "from_column AS `column`", "*").drop(
        "from_table", "from_column"
    )
    return finding(
        rows, "CHK-13", 0, "REFERENTIAL",
        check_id="CASE WHEN confidence = 'HIGH' THEN 'CHK-13' ELSE 'CHK-14' END",
        severity="confidence",
        description=text("orphans"),
        affected="orphan_rows",
        examples="examples",
        suggestion="concat('Add the orphaned codes to [', to_table, '] or keep their rows apart; never drop them silently.')",
        explanation="concat('[', `column`, '] points to [', to_table, '.', to_column, '] (', format_number(match_share, 0), '% of values overlap); ', orphan_values, ' values have no partner there.')",
        stats=stats("orphans"),
        stage=str(REFERENCES),
        place="array(found_at.o0, found_at.o1, found_at.o2, found_at.o3)",
        snippet="'examples'", snippet_flag="'ORPHANED'",
    )


def coverage(columns: DataFrame) -> DataFrame:
    """Date columns that start later or end earlier than the widest one."""
    differences = temporal.coverage_differences(columns.where("inferred_type = 'date'"))
    parts = []
    for check_id, side in (("CHK-17", "start"), ("CHK-18", "end")):
        parts.append(
            finding(
                differences, check_id, 0 if side == "start" else 1, "TEMPORAL", f"side = '{side}'",
                is_observation="true", stage=str(COVERAGE),
                description=text(side),
                suggestion=f"concat('Check whether [', `table`, '] should {side} at ', own_date, '.')",
                explanation="concat('The dates of [', `table`, '] cover less than those of [', reference_table, ']; as-of lookups bridge this.')",
                stats=f"map('Gap in days', CAST(gap_days AS STRING), concat(`table`, ' {side}s'), own_date, concat(reference_table, ' {side}s'), reference_date)",
            )
        )
    return union_all(parts)


def isolated(relations: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Tables without a key relationship; date columns suggest an as-of lookup."""
    dates = (
        columns.where("inferred_type = 'date'")
        .groupBy("table")
        .agg(F.sort_array(F.collect_list(F.struct("position", "column"))).alias("d"))
        .select("table", F.array_join(F.transform("d", lambda x: x["column"]), ", ").alias("dates"))
    )
    rows = relate.unconnected_tables(relations, tables).join(dates, "table", "left").withColumn(
        "found_dates", F.coalesce("dates", F.lit("None"))
    )
    return finding(
        rows, "CHK-19", 0, "ARCHITECTURE", column="NULL", is_observation="true",
        stage=str(ISOLATION), place="array(table_position)",
        description=f"concat({text('isolated')}, coalesce(concat(' — date column(s) [', dates, '] suggest as-of date logic is required'), ''))",
        suggestion="'Do not join by key; look values up by date.'",
        explanation="concat('[', `table`, '] shares no key or code column with another table.')",
        stats=stats("isolated"),
    )


def business_rules(
    profile: Profile, config: Mapping, unknown: DataFrame | None = None
) -> DataFrame:
    """Findings of the configured rules; one row per violated rule.

    A finding on allowed values gives the number of unknown values and the first few; all of
    them are the rows of `unknown`, which is computed here if the run has not done so."""
    configured = list(config.get("business_rules", []))
    number = {id(r): i for i, r in enumerate(configured)}
    sizes = {t["table"]: t["row_count"] for t in profile.table_rows}
    found = []

    def add(rule, check_id, severity, category, name, affected, flag="", examples=(), **parts):
        parts |= {"id": rule.get("id", "?"), "column": rule.get("column"), "table": rule["applies_to"]}
        found.append({
            "rule": number[id(rule)], "check_id": check_id, "severity": severity,
            "category": category, "table": rule["applies_to"], "column": rule.get("column"),
            "description": K.RULE_TEXT[name].format(**parts), "affected": affected,
            "examples": list(examples),
            "suggestion": rule.get("note", K.RULE_SUGGESTION[name].format(**parts)), "flag": flag,
        })

    for rule in rules.missing_columns(profile.tables, configured):
        add(rule, "CHK-09", "HIGH", "STRUCTURE", "missing_column", sizes[rule["applies_to"]])
    if unknown is None and rules.allowed_value_rules(profile.tables, configured):
        unknown = cut(rules.all_unknown_values(profile.tables, configured))
    if unknown is not None:
        totals = unknown.groupBy("rule").agg(
            F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")
        )
        ranked = F.row_number().over(Window.partitionBy("rule").orderBy("value"))
        first = (
            unknown.withColumn("rank", ranked).where(f"rank <= {K.EXAMPLES}").groupBy("rule")
            .agg(F.sort_array(F.collect_list("value")).alias("first"))
        )
        for r in totals.join(first, "rule").orderBy("rule").collect():  # one row per rule
            add(configured[r["rule"]], "CHK-08", "LOW", "INTEGRITY", "unknown_values", r["rows"],
                "UNKNOWN VALUE", r["first"], values=r["values"])
    by_id = {i: r for i, r in enumerate(configured)}
    for rule in rules.range_violations(profile.typed, [r | {"_n": i} for i, r in by_id.items()]):
        if rule["affected"]:
            add(by_id[rule["_n"]], "X6", "LOW", "INTEGRITY", "value_range", rule["affected"],
                outside=rule["affected"], min=rule.get("min"), max=rule.get("max"))
    rows = local(
        profile.spark, found,
        "rule int, check_id string, severity string, category string, table string, "
        "column string, description string, affected bigint, examples array<string>, "
        "suggestion string, flag string",
    )
    return finding(
        rows, "", 0, "", check_id="check_id", category="category", severity="severity",
        description="description", affected="affected", examples="examples",
        suggestion="suggestion", stage=str(RULES), place="array(rule)",
        explanation="concat('The configuration demands otherwise for [', `table`, '].')",
        snippet="CASE WHEN flag <> '' THEN 'examples' END", snippet_flag="flag",
    )


# ---- all findings -----------------------------------------------------------------


def _snippet_condition(row, profile: Profile) -> str | None:
    """The row condition behind a finding, on the typed table."""
    column = quoted(row["column"]) if row["column"] else None
    facts = next(
        (r for r in profile.rows if (r["table"], r["column"]) == (row["table"], row["column"])), {}
    )
    kind = row["snippet"]
    if kind == "empty":
        return " AND ".join(f"{quoted(c)} IS NULL" for c in profile.tables[row["table"]].columns)
    if kind == "null":
        return f"{column} IS NULL"
    if kind == "outlier":
        low, high = facts["outlier_fence_lo"], facts["outlier_fence_hi"]
        return f"(CAST({column} AS DOUBLE) < {low!r}D OR CAST({column} AS DOUBLE) > {high!r}D)"
    if kind == "negative":
        return f"CAST({column} AS DOUBLE) < 0"
    if kind == "future":
        return f"CAST({column} AS TIMESTAMP_NTZ) > TIMESTAMP_NTZ {literal(profile.as_of)}"
    if kind == "encoding":
        return f"{column} RLIKE {literal(K.CONTROL_CHARACTERS)}"
    if kind in ("examples", "keys"):
        values = ", ".join(literal(v) for v in row["examples"])
        return f"CAST({column} AS STRING) IN ({values})" if values else None
    return None


def _snippets(profile: Profile, rows: list[dict]) -> dict[int, list]:
    """Snippet rows per finding: one scan per table, all tables in one job."""
    parts = []
    for table, df in profile.tables.items():
        # raw nulls for null findings, typed values for the others
        for source, kinds in ((df, ("empty", "null", "examples", "keys", "encoding")),
                              (profile.typed[table], ("outlier", "negative", "future"))):
            conditions = {}
            for i, row in enumerate(rows):
                if row["table"] == table and row["snippet"] in kinds:
                    condition = _snippet_condition(row, profile)
                    if condition:
                        conditions[i] = condition
            if conditions:
                parts.append(snippets.first_rows(source, conditions))
        for i, row in enumerate(rows):
            if row["table"] == table and row["snippet"] == "duplicates":
                groups = profile.duplicate_groups[table]
                parts.append(snippets.first_copies(groups, i, df.columns))
    found: dict[int, list] = {}
    if parts:
        for r in sorted(union_all(parts).collect(), key=lambda r: (r["entry"], r["rank"])):
            row = rows[r["entry"]]
            marks = {"__flag__": row["snippet_flag"], "__highlight__": row["column"] or ""}
            found.setdefault(r["entry"], []).append(list((dict(r["row"]) | marks).items()))
    return found


def all_findings(
    profile: Profile, config: Mapping | None = None, with_snippets: bool = True,
    with_additions: bool = False, unknown: DataFrame | None = None,
) -> DataFrame:
    """Every finding in order: issues before observations, by severity, then as they arise.

    The result has at most a few rows per column, so ordering it in one task is fine."""
    configured, _ = together(
        profile.spark,
        lambda: business_rules(profile, config or {}, unknown),
        lambda: profile.relationships,
    )
    parts = [check(profile.table_profile) for check in TABLE_CHECKS]
    parts += [check(profile.columns) for check in COLUMN_CHECKS]
    if with_additions:
        parts.append(encoding(profile.columns))
    parts += [
        orphans(profile.relationships, profile.value_members),
        coverage(profile.columns),
        isolated(profile.relationships, profile.table_profile, profile.columns),
    ]
    parts.append(configured)
    rank = F.expr("CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END")
    order = Window.partitionBy(F.lit(1)).orderBy("is_observation", rank, "stage", "place", "step")
    numbered = union_all(parts).withColumn("ordinal", F.row_number().over(order))
    rows = sorted((r.asDict() for r in numbered.collect()), key=lambda r: r["ordinal"])
    for row in rows:
        if row["snippet"] == "keys":
            keys = duplicates.first_duplicate_keys(profile.tables[row["table"]], row["column"])
            row["examples"] = [
                r["key"] for r in keys.select(F.col("key").cast("string")).collect()
                if r["key"] is not None
            ]
        row["stats"] = list((row["stats"] or {}).items())
        row["examples"] = row["examples"] or []
    captured = _snippets(profile, rows) if with_snippets else {}
    for i, row in enumerate(rows):
        row["snippet_rows"] = captured.get(i, [])
    return local(profile.spark, rows, FINDINGS)
