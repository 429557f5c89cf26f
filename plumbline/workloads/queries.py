"""Registered queries: one per operator or check, each with its oracle SQL where SQL can say it.

Every query reads the whole given tables of the folder it is called with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import parsing as P
from plumbline.functions.columns import ref
from plumbline.operators import (
    distinct, drift, duplicates, facts, footers, infer, measures, ordered, relate, remediate, rules,
    statistics, temporal,
)
from plumbline.plans import checks, incremental, results
from plumbline.plans.profile import profile
from plumbline.plans.quality import run_quality
from plumbline.session import checkpoint_dir, pin, union_all
from plumbline.sources import catalog, sinks, snapshots
from plumbline.workloads import oracle as O
from plumbline.workloads.views import AS_OF, table, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(
        *[
            F.round(ref(f.name), digits).alias(f.name)
            if f.dataType.simpleString() == "double"
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def shown(findings: DataFrame) -> DataFrame:
    return findings.select(
        "check_id", "severity", "category", "table", "column", "description", "affected"
    )


def scratch(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


CODED = ["orders_coded", "customers_coded", "nations_coded", "suppliers_coded", "parts_coded",
         "lineitems_coded"]
BOOK = ["transactions", "products", "portfolios", "fx", "prices"]
GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
EVERY = [*GIVEN, "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
MEASURED = ["lineitem", "orders"]

# ---- profiles -----------------------------------------------------------------------


@query(
    O.with_clause(EVERY, O.table_counts(EVERY))
    + """SELECT tab AS "table", tab AS source, row_count, col_count,
      array_to_string(columns[1:5], ', ') || CASE WHEN len(columns) > 5 THEN ' …' ELSE '' END
        AS first_columns FROM t"""
)
def profile_tables(spark, folder):
    sizes = facts.table_sizes(tables(spark, folder, EVERY))
    return results.source_inventory(sizes)


@query(
    O.with_clause(EVERY, O.table_counts(EVERY))
    + "SELECT count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows, "
    "CAST(sum(col_count) AS BIGINT) AS total_columns FROM t"
)
def profile_totals(spark, folder):
    return results.totals(facts.table_sizes(tables(spark, folder, EVERY)))


DIRTY = ["dirty_orders", "dirty_orders_empty", "dirty_strings"]


@query(
    O.with_clause(DIRTY, *O.profiled(DIRTY))
    + 'SELECT tab AS "table", col AS "column", row_count, null_count, null_pct FROM p'
)
def profile_nulls(spark, folder):
    return facts.null_profile(tables(spark, folder, DIRTY)).drop("position")


@query(
    O.with_clause(EVERY, *O.profiled(EVERY))
    + """SELECT tab AS "table", col AS "column", unique_count, unique_pct,
      CAST(repeated_rows AS BIGINT) AS repeated_rows FROM p WHERE kind <> 'other'"""
)
def profile_distinct(spark, folder):
    given = tables(spark, folder, EVERY)
    sizes = facts.table_sizes(given).select("table", "row_count")
    return distinct.distinct_counts(given).join(F.broadcast(sizes), "table").select(
        "table", "column", "unique_count",
        P.percent(F.col("unique_count"), F.col("row_count")).alias("unique_pct"),
        "repeated_rows",
    )


@query(
    O.with_clause(MEASURED, *O.profiled(MEASURED))
    + """SELECT tab AS "table", col AS "column", round(num_min, 4) AS num_min,
      round(num_max, 4) AS num_max, round(num_mean, 4) AS num_mean, round(num_std, 4) AS num_std,
      round(q1, 4) AS num_q1, round(q3, 4) AS num_q3, round(iqr, 4) AS num_iqr,
      negative_count > 0 AS has_negatives FROM p WHERE typ = 'numeric'"""
)
def profile_numeric(spark, folder):
    found = profile(tables(spark, folder, MEASURED), stages=("quartiles",)).columns
    return rounded(
        found.where("inferred_type = 'numeric'").select(
            "table", "column", "num_min", "num_max", "num_mean", "num_std", "num_q1", "num_q3",
            "num_iqr", "has_negatives",
        )
    )


DATED = ["orders", "lineitem", "events", "dirty_orders"]


@query(
    O.with_clause(DATED, *O.profiled(DATED))
    + """SELECT tab AS "table", col AS "column", date_min, date_max, date_future
      FROM p WHERE typ = 'date'"""
)
def profile_dates(spark, folder):
    found = facts.column_facts(tables(spark, folder, DATED), (facts.DATES,), AS_OF)
    return found.where("kind = 'date'").select(
        "table", "column", "date_min", "date_max", "date_future"
    )


COUNTED = {"orders": ["o_orderstatus", "o_orderpriority"], "part": ["p_brand", "p_type", "p_name"],
           "events": ["event_type", "props"]}


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", * FROM (
          SELECT "{c}" AS value, count(*) AS n,
            CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") AS INTEGER) AS rank
          FROM {t} GROUP BY "{c}") WHERE rank <= 10"""
        for t, cs in COUNTED.items() for c in cs
    )
)
def profile_top_values(spark, folder):
    counts = distinct.value_counts(tables(spark, folder, COUNTED), COUNTED)
    return distinct.top_values(counts).select("table", "column", "value", "n", "rank")


@query(
    O.with_clause(MEASURED, *O.profiled(MEASURED))
    + """SELECT tab AS "table", col AS "column", round(num_std_raw / num_mean_raw, 4) AS cv
      FROM (SELECT *, num_std AS num_std_raw, num_mean AS num_mean_raw FROM p)
      WHERE typ = 'numeric'"""
)
def profile_cv(spark, folder):
    return rounded(statistics.variation(tables(spark, folder, MEASURED)))


# ---- types, keys, relationships -----------------------------------------------------

TYPED = [*CODED, "dirty_strings", "dirty_orders", "documents", "events", "embeddings", "pages"]


@query(
    O.with_clause(TYPED, *O.profiled(TYPED))
    + 'SELECT tab AS "table", col AS "column", typ AS inferred_type FROM p'
)
def infer_types(spark, folder):
    return infer.infer_types(tables(spark, folder, TYPED)).select(
        "table", "column", "inferred_type"
    )


KEYED = [*CODED, "dirty_orders", "dirty_orders_dups", *BOOK, "nation", "events"]


@query(
    O.with_clause(KEYED, *O.profiled(KEYED))
    + 'SELECT tab AS "table", col AS likely_pk, score FROM p WHERE pk'
)
def infer_pk(spark, folder):
    found = infer.infer_columns(tables(spark, folder, KEYED), families=(facts.NULLS,))
    return infer.key_candidates(found).where("rank = 1").select(
        "table", F.col("column").alias("likely_pk"), "score"
    )


@query(
    O.with_clause(KEYED, *O.profiled(KEYED))
    + 'SELECT tab AS "table", col AS "column", unique_pct FROM p WHERE fk'
)
def infer_fk(spark, folder):
    found = infer.infer_columns(tables(spark, folder, KEYED), families=(facts.NULLS,))
    return found.where("is_likely_fk").select("table", "column", "unique_pct")


@query(
    O.with_clause(CODED, *O.profiled(CODED))
    + f"""SELECT a.tab AS a_table, a.col AS a_column, b.tab AS b_table, b.col AS b_column,
      round({O.similarity('a.col', 'b.col')}, 4) AS similarity
      FROM p a JOIN p b ON a.typ = b.typ AND a.tab < b.tab
      WHERE {O.similarity('a.col', 'b.col')} > 0"""
)
def name_similarity(spark, folder):
    found = infer.infer_types(tables(spark, folder, CODED))
    names = pin(found.select("table", "column", "inferred_type"))  # one row per column
    a = names.select(F.col("table").alias("a_table"), F.col("column").alias("a_column"), "inferred_type")
    b = names.select(F.col("table").alias("b_table"), F.col("column").alias("b_column"), "inferred_type")
    similar = P.name_similarity(F.col("a_column"), F.col("b_column"))
    # only names that share a word meet; all others have a similarity of 0
    a = a.withColumn("word", F.explode(P.name_words(F.col("a_column"))))
    b = b.withColumn("word", F.explode(P.name_words(F.col("b_column"))))
    met = a.join(b, ["inferred_type", "word"]).where("a_table < b_table").drop("word").distinct()
    return met.select(
        "a_table", "a_column", "b_table", "b_column", F.round(similar, 4).alias("similarity")
    )


RELATION_FIELDS = (
    "from_table, from_column, to_table, to_column, confidence, match_pct, reason, "
    "orphan_values, orphan_rows"
)


@query(
    O.with_clause(CODED, *O.related(CODED))
    + """SELECT ft AS from_table, fc AS from_column, tt AS to_table, tc AS to_column, confidence,
      round_even(pct, 1) AS match_pct, reason, orphan_values,
      CAST(orphan_rows AS BIGINT) AS orphan_rows FROM rel"""
)
def discover_relationships(spark, folder):
    found = profile(tables(spark, folder, CODED), stages=())
    return found.relationships.select(*RELATION_FIELDS.split(", "))


RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query(
    O.with_clause(RAW, *O.related(RAW, integer_keys=True))
    + """SELECT ft AS from_table, fc AS from_column, tt AS to_table, tc AS to_column, confidence,
      round_even(pct, 1) AS match_pct, reason, orphan_values,
      CAST(orphan_rows AS BIGINT) AS orphan_rows FROM rel"""
)
def discover_relationships_integer(spark, folder):
    """The given tables as they are: whole numbers named like keys take part."""
    found = profile(tables(spark, folder, RAW), stages=(), integer_keys=True)
    return found.relationships.select(*RELATION_FIELDS.split(", "))


# ---- checks -------------------------------------------------------------------------


@query(O.check(["dirty_orders", "fx"], O.nulls(), *O.profiled(["dirty_orders", "fx"])))
def check_nulls(spark, folder):
    return shown(checks.nulls(profile(tables(spark, folder, ["dirty_orders", "fx"]), stages=("distinct",)).columns))


@query(
    O.check(["dirty_orders"], O.nulls(),
            *O.profiled(["dirty_orders"])[:1],
            O.TYPED.strip().replace("score IS NOT NULL AND row_number()",
                                    "col = 'o_custkey' AND 1 <= row_number()")
            .replace("LAST, pos) = 1 AS pk", "LAST, pos) AS pk"))
)
def check_nulls_declared_key(spark, folder):
    """With a declared key, nulls in a primary key can be found."""
    given = tables(spark, folder, ["dirty_orders"])
    found = profile(given, declared_keys={"dirty_orders": "o_custkey"}, stages=("distinct",))
    return shown(checks.nulls(found.columns))


@query(O.check(["dirty_orders_empty"], O.empty_rows(), O.table_counts(["dirty_orders_empty"])))
def check_empty_rows(spark, folder):
    return shown(checks.empty_rows(facts.table_sizes(tables(spark, folder, ["dirty_orders_empty"]))))


DUPLICATED = ["dirty_orders_dups", "orders", "nation"]


@query(O.check(DUPLICATED, O.duplicate_rows(), O.table_counts(DUPLICATED, duplicates=True)))
def check_duplicate_rows(spark, folder):
    found = profile(tables(spark, folder, DUPLICATED), stages=("distinct", "duplicates"))
    return shown(checks.duplicate_rows(found.table_profile))


@query(
    O.check(["dirty_orders_dups", "orders"], O.duplicate_keys(["dirty_orders_dups", "orders"]),
            *O.profiled(["dirty_orders_dups", "orders"]))
)
def check_duplicate_pk(spark, folder):
    found = profile(tables(spark, folder, ["dirty_orders_dups", "orders"]), stages=("distinct",))
    return shown(checks.duplicate_keys(found.table_profile))


@query(O.check(["nation", "part"], O.high_cardinality(), *O.profiled(["nation", "part"])))
def check_high_cardinality(spark, folder):
    return shown(checks.high_cardinality(profile(tables(spark, folder, ["nation", "part"]), stages=("distinct",)).columns))


TYPE_RULE = {
    "id": "BR-001", "applies_to": "products", "validator": "allowed_values",
    "column": "product-type", "values": ["LN", "EQ", "FI", "FX", "CASH"],
}
COLUMN_RULE = {
    "id": "BR-002", "applies_to": "products", "validator": "column_exists",
    "column": "product-rating",
}
PRESENT_RULE = {
    "id": "BR-003", "applies_to": "products", "validator": "column_exists",
    "column": "product-type",
}
NAME_RULE = {
    "id": "BR-005", "applies_to": "customer", "validator": "allowed_values",
    "column": "c_name", "values": ["no such customer"],
}
SEGMENT_RULE = NAME_RULE | {"id": "BR-006", "column": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]}
RANGE_RULE = {
    "id": "BR-004", "applies_to": "products", "validator": "value_range",
    "column": "loan-property-value-ratio", "min": 0.5, "max": 10,
}


def _rules(spark, folder, *configured):
    names = list(dict.fromkeys(rule["applies_to"] for rule in configured))
    found = profile(tables(spark, folder, names), stages=("distinct",))
    return shown(checks.business_rules(found, {"business_rules": list(configured)}))


@query(
    O.check(
        ["products", "customer"],
        " UNION ALL ".join(
            O.rule_values(i, r) for i, r in enumerate([TYPE_RULE, NAME_RULE, SEGMENT_RULE])
        ),
    )
)
def check_allowed_values(spark, folder):
    return _rules(spark, folder, TYPE_RULE, NAME_RULE, SEGMENT_RULE)


@query(
    O.with_clause(["products", "customer"])
    + " UNION ALL ".join(
        f"""SELECT {i} AS rule, '{r['id']}' AS rule_id, '{r['applies_to']}' AS "table",
      '{r['column']}' AS "column", "{r['column']}" AS value, count(*) AS n FROM {r['applies_to']}
      WHERE "{r['column']}" NOT IN ({", ".join(f"'{v}'" for v in r['values'])}) GROUP BY 5"""
        for i, r in enumerate([TYPE_RULE, NAME_RULE, SEGMENT_RULE])
    )
)
def rule_all_unknown_values(spark, folder):
    """Every unknown value of every rule, the customer names among them."""
    given = tables(spark, folder, ["products", "customer"])
    return rules.all_unknown_values(given, [TYPE_RULE, NAME_RULE, SEGMENT_RULE])


@query(O.check(["products"], O.rule_column(0, COLUMN_RULE)))
def check_column_exists(spark, folder):
    return _rules(spark, folder, COLUMN_RULE, PRESENT_RULE)


@query(O.check(["products"], O.rule_range(0, RANGE_RULE)))
def check_value_range(spark, folder):
    return _rules(spark, folder, RANGE_RULE)


@query(
    O.with_clause(["products"])
    + """SELECT "product-type" AS value, count(*) AS n FROM products
      WHERE "product-type" NOT IN ('LN', 'EQ', 'FI', 'FX', 'CASH') GROUP BY 1"""
)
def rule_unknown_values(spark, folder):
    return rules.unknown_values(table(spark, folder, "products"), "product-type", TYPE_RULE["values"])


TEXTS = ["dirty_strings", "conversations"]


@query(O.check(TEXTS, O.mixed_types(), *O.profiled(TEXTS)))
def check_mixed_types(spark, folder):
    return shown(checks.mixed_types(profile(tables(spark, folder, TEXTS), stages=()).columns))


@query(O.check([*TEXTS, "documents", "pages"], O.encoding(), *O.profiled([*TEXTS, "documents", "pages"])))
def check_encoding(spark, folder):
    names = [*TEXTS, "documents", "pages"]
    return shown(checks.encoding(profile(tables(spark, folder, names), stages=()).columns))


@query(O.check(["dirty_strings"], O.unparsed_dates(), *O.profiled(["dirty_strings"])))
def check_unparsed_dates(spark, folder):
    return shown(checks.unparsed_dates(profile(tables(spark, folder, ["dirty_strings"]), stages=()).columns))


@query(
    O.with_clause(["dirty_strings"])
    + f"""SELECT o_orderkey, {O.moment('date_txt', 'string')} AS date_value,
      {O.number('price_txt', 'string')} AS price_value FROM dirty_strings"""
)
def src_date_coerce(spark, folder):
    df = catalog.coerce_dates(table(spark, folder, "dirty_strings"), ["date_txt"])
    return df.select(
        "o_orderkey", F.col("date_txt").alias("date_value"),
        P.to_number(F.col("price_txt")).alias("price_value"),
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS mixed,
      CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS american FROM orders"""
)
def src_date_forms(spark, folder):
    """Order dates written in seven forms by formula and parsed back; the second column is month
    first throughout, which its days above 12 prove."""
    forms = (
        "yyyyMMdd", "dd-MMM-yyyy", "d MMMM yyyy", "dd/MM/yy", "d.M.yyyy", "yyyy/M/d", "yyyy-MM-dd",
    )
    chosen = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        written = F.date_format("o_orderdate", form)
        chosen = F.when(F.col("o_orderkey") % len(forms) == k, written).otherwise(chosen)
    texts = table(spark, folder, "orders").select(
        "o_orderkey", chosen.alias("mixed"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("american")
    )
    return catalog.coerce_dates(texts, ["mixed", "american"])


SPREAD = ["events", "documents", "dirty_lineitem", "dirty_orders", "products"]


@query(
    O.check(
        SPREAD, O.outliers(), O.quartiles(SPREAD), O.FENCED.strip(), O.outlier_counts(SPREAD, (O.N,))
    )
)
def check_iqr_outliers(spark, folder):
    return shown(checks.outliers(profile(tables(spark, folder, SPREAD), stages=("quartiles",)).columns))


SIGNED = ["dirty_orders", "transactions", "supplier"]


@query(O.check(SIGNED, O.negatives(), *O.profiled(SIGNED)))
def check_negative(spark, folder):
    return shown(checks.negatives(profile(tables(spark, folder, SIGNED), stages=()).columns))


@query(O.check(["dirty_orders", "events"], O.future_dates(), *O.profiled(["dirty_orders", "events"])))
def check_future_dates(spark, folder):
    given = tables(spark, folder, ["dirty_orders", "events"])
    return shown(checks.future_dates(profile(given, AS_OF, stages=()).columns))


@query(
    O.with_clause(CODED, *O.related(CODED))
    + f"SELECT {O.SHOWN}, examples FROM ({O.orphans()})"
)
def check_orphans(spark, folder):
    found = profile(tables(spark, folder, CODED), stages=())
    listed = checks.orphans(found.relationships, found.value_members)
    return listed.select(
        "check_id", "severity", "category", "table", "column", "description", "affected",
        F.array_join("examples", "|").alias("examples"),
    )


SERIES = ["fx", "prices", "orders", "lineitem", "events", "dirty_strings"]


@query(
    O.with_clause(SERIES, *O.profiled(SERIES), O.gap_counts(SERIES, text=True))
    + """SELECT tab AS "table", col AS "column", gaps AS date_gaps
      FROM gaps JOIN p USING (tab, col) WHERE typ = 'date'"""
)
def profile_date_gaps(spark, folder):
    found = profile(tables(spark, folder, SERIES), stages=("gaps",)).columns
    return found.where("inferred_type = 'date'").select("table", "column", "date_gaps")


@query(O.check(SERIES, O.date_gaps(), *O.profiled(SERIES), O.gap_counts(SERIES, text=True)))
def check_date_gaps(spark, folder):
    return shown(checks.date_gaps(profile(tables(spark, folder, SERIES), stages=("gaps",)).columns))


COVERED = ["orders", "lineitem", "events", "fx", "prices"]


@query(O.check(COVERED, O.coverage(), *O.profiled(COVERED), O.WIDEST.strip()))
def check_temporal_alignment(spark, folder):
    ranges = facts.column_facts(tables(spark, folder, COVERED), (facts.DATES,))
    order = F.array_position(F.array(*[F.lit(n) for n in COVERED]), F.col("table")) - 1
    dated = ranges.where("kind = 'date'").withColumns(
        {"table_position": order.cast("int"), "inferred_type": F.lit("date")}
    )
    return shown(checks.coverage(pin(dated)))


@query(
    O.check([*CODED, "events"], O.isolated(), *O.related([*CODED, "events"]),
            O.table_counts([*CODED, "events"]))
)
def check_disconnected(spark, folder):
    found = profile(tables(spark, folder, [*CODED, "events"]), stages=())
    return shown(checks.isolated(found.relationships, found.table_profile, found.columns))


SCORED = ["events", "orders", "dirty_lineitem", "documents"]


@query(
    O.with_clause(SCORED, *O.profiled(SCORED))
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", 
          CAST(count_if(abs(("{c}" - m) / s) > 3) AS BIGINT) AS outlier_count FROM {t}, (SELECT avg("{c}"::DOUBLE) AS m,
          stddev_samp("{c}"::DOUBLE) AS s FROM {t}) WHERE s > 0"""
        for t in SCORED for c, kind in O.COLUMNS[t] if kind == "numeric"
    )
)
def check_zscore(spark, folder):
    given = tables(spark, folder, SCORED)
    found = facts.column_facts(given, (facts.NUMBERS,)).where("kind = 'numeric'").collect()
    rows = statistics.zscore_outliers(given, found)
    return checks.local(spark, rows, "table string, column string, outlier_count bigint")


BENFORD = {"orders": ["o_totalprice"], "lineitem": ["l_extendedprice", "l_quantity"],
           "events": ["value"], "customer": ["c_acctbal"]}


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", d.digit, total AS positive_count,
          count(x.digit) AS digit_count, round(count(x.digit) / total::DOUBLE, 4) AS observed,
          round(log10(1 + 1.0 / d.digit), 4) AS expected
          FROM (SELECT CAST(unnest(range(1, 10)) AS INTEGER) AS digit) d
          CROSS JOIN (SELECT count(*) AS total FROM {t} WHERE "{c}" > 0) n
          LEFT JOIN (SELECT CAST(regexp_extract(CAST("{c}" AS VARCHAR), '[1-9]') AS INTEGER)
            AS digit FROM {t} WHERE "{c}" > 0) x ON x.digit = d.digit
          WHERE total >= 30 GROUP BY d.digit, total"""
        for t, cs in BENFORD.items() for c in cs
    )
)
def check_benford(spark, folder):
    return rounded(statistics.first_digits(tables(spark, folder, BENFORD), BENFORD))


FREQUENT = {
    "documents": ["text", "lang", "source"], "conversations": ["text", "role"], "pages": ["url"],
    "lineitem": ["l_shipdate", "l_partkey", "l_quantity"], "events": ["event_type"],
}


@query(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER)
          AS rank, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} QUALIFY rank <= 10"""
        for t, cs in FREQUENT.items() for c in cs
    ) + ")"
)
def profile_heavy_values(spark, folder):
    """The most frequent values of whole columns, long texts and numbers among them."""
    return distinct.heavy_values(tables(spark, folder, list(FREQUENT)), FREQUENT)


@query(
    O.with_clause(GIVEN, *O.profiled(GIVEN))
    + """SELECT tab AS "table", col AS "column", row_count, null_count, round(num_min, 4) AS num_min,
      round(num_max, 4) AS num_max, date_min, date_max FROM p"""
)
def profile_footers(spark, folder):
    """Counts and bounds of whole files from their footers; fractions and moments are scanned."""
    paths = {name: f"{folder}/{name}.parquet" for name in GIVEN}
    found = footers.footer_facts(spark, paths)
    return rounded(found.drop("position", "kind", "from_footer"))


GROWING = ["dirty_orders_empty", "dirty_strings"]


@query(
    O.with_clause(GROWING, *O.profiled(GROWING))
    + """SELECT tab AS "table", col AS "column", typ AS inferred_type, row_count, null_count, unique_count,
      CAST(repeated_rows AS BIGINT) AS repeated_rows, pk AS is_likely_pk, fk AS is_likely_fk,
      round(num_min, 4) AS num_min, round(num_max, 4) AS num_max, round(num_mean, 4) AS num_mean,
      round(num_std, 4) AS num_std, date_min, date_max,
      CAST(CASE WHEN tab = 'dirty_strings' THEN 1 ELSE 2 END AS BIGINT) AS files_read FROM p"""
)
def profile_incremental(spark, folder):
    """Tables that grow by files: profiled, then extended by one or two files and profiled again. The second
    profile reads the new files only."""
    parts = []
    for name in GROWING:
        path = scratch(spark)
        rows = table(spark, folder, name).withColumn("part", F.pmod(F.xxhash64("o_orderkey"), F.lit(3)))
        for numbers in ((0, 1), (2,)) if name == "dirty_strings" else ((0,), (1, 2)):
            for number in numbers:
                some = rows.where(F.col("part") == number).drop("part")
                some.coalesce(1).write.mode("append").parquet(f"{path}/rows")
            found = incremental.profile_files(spark, f"{path}/rows", f"{path}/state", name, AS_OF)
        parts.append(found.columns.withColumn("files_read", F.lit(len(found.read)).cast("bigint")))
    return rounded(
        union_all(parts).select(
            "table", "column", "inferred_type", "row_count", "null_count", "unique_count", "repeated_rows",
            "is_likely_pk", "is_likely_fk", "num_min", "num_max", "num_mean", "num_std", "date_min", "date_max",
            "files_read",
        )
    )


# ---- drift ---------------------------------------------------------------------------

# the book as delivered: one column dropped, one added, one table missing, one versioned
DELIVERED = {
    "transactions": ["transaction-code", "portfolio-code", "product-code",
                     "transaction-quantity", "transaction-price", "transaction-date", "desk"],
    "products": ["product-code", "product-type", "product-currency", "product-issuer-code"],
    "fx_v2": ["price-date", "EURUSD"],
    "prices": ["price-date", "P1-EUR", "P2-USD"],
    "notes": ["text"],
}


def _delivered(spark, folder):
    """The derived book with the faults above; only the schemas of these tables are used."""
    book = tables(spark, folder, BOOK)
    return {
        "transactions": book["transactions"].withColumn("desk", F.lit("A")),
        "products": book["products"].drop("loan-property-value-ratio"),
        "fx_v2": book["fx"],
        "prices": book["prices"],
        "notes": table(spark, folder, "documents").select("text"),
    }


def _sql_catalogue(schema: dict[str, list[str]]) -> str:
    return "(VALUES " + ", ".join(
        f"('{t}', '{c}', {i})" for t, cs in schema.items() for i, c in enumerate(cs)
    ) + ")"


@query(
    O.with_clause(["transactions", "products", "fx"])
    + f""", have AS (SELECT regexp_replace(t, '_v\\d+$', '', 'i') AS t, c
        FROM {_sql_catalogue(DELIVERED)} x(t, c, i)),
    want AS (SELECT t, c FROM {_sql_catalogue(drift.K.EXPECTED_SCHEMA)} x(t, c, i)),
    events AS (SELECT DISTINCT 'TABLE_MISSING' AS "type", t AS "table", NULL AS "column", 'HIGH' AS risk
      FROM want WHERE t NOT IN (SELECT t FROM have)
    UNION ALL SELECT 'COLUMN_MISSING', t, c, 'HIGH' FROM want
      WHERE t IN (SELECT t FROM have) AND (t, c) NOT IN (SELECT t, c FROM have)
    UNION ALL SELECT 'COLUMN_ADDED', t, c, 'LOW' FROM have
      WHERE t IN (SELECT t FROM want) AND (t, c) NOT IN (SELECT t, c FROM want)),
    sizes AS (SELECT 'transactions' AS "table", count(*) AS row_count FROM transactions
      UNION ALL SELECT 'products', count(*) FROM products
      UNION ALL SELECT 'fx', count(*) FROM fx)
    SELECT * FROM events LEFT JOIN sizes USING ("table")"""
)
def drift_schema(spark, folder):
    """Drift events with the rows of the table concerned."""
    delivered = _delivered(spark, folder)
    events = drift.schema_drift(spark, drift.schema_of(delivered))
    sizes = facts.table_sizes(delivered).select(
        drift.normalised_name().alias("table"), "row_count"
    )
    return events.join(sizes, "table", "left").select(
        "type", "table", "column", "risk", "row_count"
    )


BEFORE, NOW = ["orders", "part", "events"], ["dirty_orders_dups", "part_gap", "nation"]


def _renamed(spark, folder):
    """A former and a present state of the given tables: rows added and removed, a column
    dropped, a table dropped and a table added."""
    before = {"orders": "orders", "part": "part", "events": "events"}
    now = {"orders": "dirty_orders_dups", "part": "part_gap", "nation": "nation"}
    old = {n: table(spark, folder, v) for n, v in before.items()}
    new = {n: table(spark, folder, v) for n, v in now.items()}
    new["part"] = new["part"].drop("p_size").withColumn("p_colour", F.lit("red"))
    return old, new


@query(
    O.with_clause(NOW)
    + """SELECT 'TABLE_REMOVED' AS "type", 'events' AS "table", NULL AS "column", 'HIGH' AS risk,
        'table removed' AS detail
    UNION ALL SELECT 'TABLE_ADDED', 'nation', NULL, 'MEDIUM', 'table added'
    UNION ALL SELECT 'COLUMN_REMOVED', 'part', 'p_size', 'HIGH', 'column removed'
    UNION ALL SELECT 'COLUMN_ADDED', 'part', 'p_colour', 'MEDIUM', 'column added'
    UNION ALL SELECT 'ROW_COUNT_CHANGE', 'part', NULL, 'LOW',
        (SELECT count(*) FROM part) || ' -> ' || (SELECT count(*) FROM part_gap)
    UNION ALL SELECT 'ROW_COUNT_CHANGE', 'orders', NULL, 'LOW',
        (SELECT count(*) FROM orders) || ' -> ' || (SELECT count(*) FROM dirty_orders_dups)"""
)
def drift_baseline(spark, folder):
    old, new = _renamed(spark, folder)
    return drift.snapshot_drift(
        pin(facts.table_sizes(old)), pin(facts.table_sizes(new))
    )


@query(
    O.with_clause(["orders_coded", "parts_coded"])
    + """SELECT 'parts' AS "table", 'part_code' AS "column",
      'PRT-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS value, count(*) AS n
      FROM part WHERE p_partkey % 50 = 0 GROUP BY ALL"""
)
def drift_value_set(spark, folder):
    """Baseline: parts without every fiftieth code; now: all parts."""
    now = table(spark, folder, "products").select(ref("product-code").alias("part_code"))
    before = table(spark, folder, "parts_coded").select("part_code")
    listed = {"parts": ["part_code"]}
    return drift.value_set_drift(
        distinct.value_counts({"parts": before}, listed),
        distinct.value_counts({"parts": now}, listed),
    )


@query(
    O.with_clause(["dirty_orders"])
    + """SELECT * FROM (
      SELECT 'orders' AS "table", 'o_totalprice' AS "column", old_min, old_max, new_min, new_max,
        round(abs(new_min - old_min) / abs(old_min), 4) AS min_change,
        round(abs(new_max - old_max) / abs(old_max), 4) AS max_change
      FROM (SELECT min(o_totalprice) AS old_min, max(o_totalprice) AS old_max FROM orders),
        (SELECT min(o_totalprice) AS new_min, max(o_totalprice) AS new_max FROM dirty_orders))
      WHERE greatest(min_change, max_change) > 0.5"""
)
def drift_numeric_range(spark, folder):
    before = facts.column_facts({"orders": table(spark, folder, "orders")}, (facts.NUMBERS,))
    now = facts.column_facts({"orders": table(spark, folder, "dirty_orders")}, (facts.NUMBERS,))
    numeric = "kind = 'numeric'"
    return rounded(drift.numeric_range_drift(before.where(numeric), now.where(numeric)))


@query(
    O.with_clause(["fx"], O.table_counts(["orders", "part", "fx"]))
    + """SELECT '2024-01-02 00:00:00' AS saved_at, 'fx.csv|orders.parquet|part' AS files,
      string_agg(tab, '|' ORDER BY tab) AS tables,
      CAST(sum(row_count) AS BIGINT) AS total_rows FROM t"""
)
def drift_snapshot(spark, folder):
    """Two runs are appended; the later one is read back, whatever the order of their ids. A third
    is broken off before its commit."""
    path = scratch(spark)
    files = {"orders": "in/orders.parquet", "fx_v2": "in/fx.csv"}
    names = {"orders": "orders", "part": "part", "fx_v2": "fx"}
    given = {n: table(spark, folder, v) for n, v in names.items()}
    sizes = pin(facts.table_sizes(given))
    first = sizes.where("`table` <> 'part'")
    snapshots.append(snapshots.snapshot(first, files, "run-9", "2024-01-01 00:00:00"), path)
    snapshots.append(snapshots.snapshot(sizes, files, "run-10", "2024-01-02 00:00:00"), path)
    broken = snapshots.snapshot(first, files, "run-11", "2024-01-03 00:00:00")
    broken.write.parquet(f"{path}/tables/written_as=broken")
    info = snapshots.baseline_info(snapshots.latest(spark, path))
    return info.select(
        "saved_at", F.array_join("files", "|").alias("files"),
        F.array_join("tables", "|").alias("tables"), "total_rows",
    )


RUN_EVENTS = """
    listed(tab, col) AS (VALUES ('orders', 'o_orderstatus'), ('orders', 'o_orderpriority')),
    was AS (SELECT 'o_orderstatus' AS col, o_orderstatus AS v FROM before_orders
      UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM before_orders),
    is_now AS (SELECT 'o_orderstatus' AS col, o_orderstatus AS v FROM orders
      UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
    fresh AS (SELECT col, v, count(*) AS n FROM is_now
      WHERE v IS NOT NULL AND (col, v) NOT IN (SELECT col, v FROM was WHERE v IS NOT NULL) GROUP BY ALL),
    named AS (SELECT col, count(*) AS vs, sum(n) AS n, list(v ORDER BY v)[1:5] AS names FROM fresh GROUP BY col),
    ranges AS (
      SELECT 'o_totalprice' AS col, min(o_totalprice) AS a, max(o_totalprice) AS b,
        (SELECT min(o_totalprice) FROM before_orders) AS c, (SELECT max(o_totalprice) FROM before_orders) AS d
      FROM orders
      UNION ALL SELECT 'o_custkey', min(o_custkey), max(o_custkey),
        (SELECT min(o_custkey) FROM before_orders), (SELECT max(o_custkey) FROM before_orders) FROM orders
      UNION ALL SELECT 'o_orderkey', min(o_orderkey), max(o_orderkey),
        (SELECT min(o_orderkey) FROM before_orders), (SELECT max(o_orderkey) FROM before_orders) FROM orders)
"""


@query(
    """WITH before_orders AS (
      SELECT * FROM orders WHERE o_totalprice < 100000 AND o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '1%'),"""
    + RUN_EVENTS
    + """SELECT 'TABLE_REMOVED' AS "type", 'part' AS "table", NULL AS "column", 'HIGH' AS risk, 'table removed' AS detail
    UNION ALL SELECT 'TABLE_ADDED', 'nation', NULL, 'MEDIUM', 'table added'
    UNION ALL SELECT 'COLUMN_REMOVED', 'orders', 'o_colour', 'HIGH', 'column removed'
    UNION ALL SELECT 'ROW_COUNT_CHANGE', 'orders', NULL, 'LOW',
      (SELECT count(*) FROM before_orders) || ' -> ' || (SELECT count(*) FROM orders)
    UNION ALL SELECT 'VALUE_SET_DRIFT', 'orders', col, 'MEDIUM',
      vs || ' new value(s) in ' || n || ' row(s): ' || array_to_string(names, ', ')
        || CASE WHEN vs > 5 THEN ', …' ELSE '' END FROM named
    UNION ALL SELECT 'NUMERIC_RANGE_DRIFT', 'orders', col, 'MEDIUM', '' FROM ranges
      WHERE abs(a - c) > 0.5 * abs(c) OR abs(b - d) > 0.5 * abs(d)"""
)
def drift_run_baseline(spark, folder):
    """A run over today's tables against the stored state of one over a part of the orders with one
    more column and one more table. Of ranges the event is compared, not the wording of its numbers."""
    now = {n: table(spark, folder, n) for n in ("orders", "nation")}
    part = now["orders"].where(
        "o_totalprice < 100000 AND o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '1%'"
    )
    before = {"orders_v1": part.withColumn("o_colour", F.lit("red")), "part": table(spark, folder, "part")}
    path, stages = scratch(spark), ("distinct",)
    old, new = (profile(t, AS_OF, stages=stages) for t in (before, now))
    kept = snapshots.state(old.tables, old.table_profile, old.columns, {}, "run-9", "2024-01-01 00:00:00")
    snapshots.append(kept.tables, path, kept.columns, kept.values)
    events = pin(
        drift.run_drift(
            snapshots.latest_state(spark, path), snapshots.state(new.tables, new.table_profile, new.columns)
        )
    )
    ranged = F.col("type") == "NUMERIC_RANGE_DRIFT"
    return events.withColumn("detail", F.when(ranged, F.lit("")).otherwise(F.col("detail")))


# ---- findings and derived tables -----------------------------------------------------

CONFIG = {"business_rules": [TYPE_RULE, COLUMN_RULE, RANGE_RULE]}


def _book_findings(names, *extra):
    return O.with_clause(
        names, *O.related(names), O.table_counts(names, duplicates=True), O.FENCED.strip(),
        O.outlier_counts(names), O.gap_counts(names), O.WIDEST.strip(),
        O.found(
            O.empty_rows(), O.duplicate_rows(), O.duplicate_keys(names), O.nulls(), O.outliers(),
            O.negatives(), O.unparsed_dates(), O.future_dates(), O.date_gaps(), O.mixed_types(),
            O.high_cardinality(), O.orphans(), O.coverage(), O.isolated(), *extra,
        ).strip(),
    )


CHECKED = [*BOOK, "dirty_orders", "nation"]
FOUND = _book_findings(
    CHECKED, O.rule_values(0, TYPE_RULE), O.rule_column(1, COLUMN_RULE), O.rule_range(2, RANGE_RULE)
)


def _findings(spark, folder, with_snippets=False):
    found = profile(
        tables(spark, folder, CHECKED), AS_OF, stages=("distinct", "quartiles", "gaps", "duplicates")
    )
    return found, checks.all_findings(found, CONFIG, with_snippets)


@query(
    FOUND + """SELECT CAST(ordinal AS INTEGER) AS ordinal, check_id, severity, category,
      tab AS "table", col AS "column", description, affected, is_observation,
      coalesce(examples, '') AS examples FROM found"""
)
def findings_all(spark, folder):
    return _findings(spark, folder)[1].select(
        "ordinal", "check_id", "severity", "category", "table", "column", "description",
        "affected", "is_observation", F.array_join("examples", "|").alias("examples"),
    )


@query(
    FOUND + """SELECT CAST(count_if(NOT is_observation AND severity = 'HIGH') AS BIGINT) AS high,
      CAST(count_if(NOT is_observation AND severity = 'MEDIUM') AS BIGINT) AS medium,
      CAST(count_if(NOT is_observation AND severity = 'LOW') AS BIGINT) AS low,
      CAST(count_if(is_observation) AS BIGINT) AS observations,
      CAST(count_if(NOT is_observation AND severity IN ('HIGH', 'MEDIUM')) AS BIGINT) AS to_remediate FROM found"""
)
def findings_summary(spark, folder):
    return results.severity_counts(_findings(spark, folder)[1])


#: What each finding advises, from the fields the oracle has; the texts are those of the checks.
ADVISED = """, advised AS (SELECT *, CASE
    WHEN check_id = 'CHK-04' THEN 'Drop the rows in which every column is null.'
    WHEN check_id = 'CHK-05' THEN 'Keep one copy of each row (dropDuplicates).'
    WHEN check_id = 'CHK-06' THEN 'Check repeated [' || col || '] values; suffixes such as -01 and -02 may be versions of one code.'
    WHEN check_id IN ('CHK-01', 'CHK-02', 'CHK-03') THEN CASE
      WHEN (SELECT typ FROM p WHERE p.tab = found.tab AND p.col = found.col) = 'date'
        THEN 'Fill [' || col || '] forward if it is a series; otherwise ask the source.'
      WHEN (SELECT typ FROM p WHERE p.tab = found.tab AND p.col = found.col) = 'numeric'
        THEN 'Impute [' || col || '] by its median or mark it as missing; zero would be wrong.'
      WHEN check_id = 'CHK-01' THEN 'Key [' || col || '] must be complete; ask the source now.'
      WHEN check_id = 'CHK-02' THEN 'Rows without [' || col || '] will not join and drop out of reports.'
      ELSE 'Find out whether nulls in [' || col || '] are expected.' END
    WHEN check_id = 'CHK-16' THEN 'Look for offsetting pairs among the large [' || col || '] values; keep them in sums.'
    WHEN check_id = 'CHK-11' THEN 'Flag outliers of [' || col || '] in a column of their own and leave flagged rows out of averages.'
    WHEN check_id = 'CHK-12' THEN 'Confirm and document the sign convention of [' || col || '].'
    WHEN check_id = 'CHK-D1' THEN 'Deliver [' || col || '] as YYYY-MM-DD.'
    WHEN check_id = 'CHK-D2' THEN 'Check [' || col || ']: dates after today may be entry errors.'
    WHEN check_id = 'CHK-15' THEN 'Check whether the days missing from [' || col || '] are intended.'
    WHEN check_id = 'CHK-10' THEN 'Set the type of [' || col || '] and turn other values into nulls.'
    WHEN check_id = 'CHK-07' THEN 'Move [' || col || '] to a lookup table if its values repeat.'
    WHEN check_id IN ('CHK-13', 'CHK-14') THEN 'Add the orphaned codes to ['
      || regexp_extract(description, 'not found in \\[(.*?)\\.', 1) || '] or keep their rows apart; never drop them silently.'
    WHEN check_id = 'CHK-17' THEN 'Check whether [' || tab || '] should start at ' || regexp_extract(description, ' starts (\\S+) ', 1) || '.'
    WHEN check_id = 'CHK-18' THEN 'Check whether [' || tab || '] should end at ' || regexp_extract(description, ' ends (\\S+) ', 1) || '.'
    WHEN check_id = 'CHK-19' THEN 'Do not join by key; look values up by date.'
    WHEN check_id = 'CHK-09' THEN 'Add [' || col || '] to [' || tab || '], or take the rule out of the configuration.'
    WHEN check_id = 'CHK-08' THEN 'Extend the allowed set or correct the listed values of [' || col || '].'
    WHEN check_id = 'X6' THEN 'Check the bounds of [' || col || '].' END AS suggestion FROM found)
"""


@query(
    FOUND + ADVISED + """SELECT CAST(ordinal AS INTEGER) AS ordinal,
      CASE WHEN is_observation THEN 'OBS' ELSE severity END AS label, category,
      concat_ws('.', tab, col) AS location, description,
      CASE WHEN length(suggestion) > 80 THEN suggestion[1:80] || '…' ELSE suggestion END AS suggestion FROM advised"""
)
def findings_overview(spark, folder):
    return results.overview(_findings(spark, folder)[1])


@query(
    FOUND + ADVISED + """SELECT CAST(ordinal AS INTEGER) AS ordinal, severity, tab AS "table", col AS "column", suggestion
      FROM advised WHERE NOT is_observation AND severity IN ('HIGH', 'MEDIUM')"""
)
def findings_to_remediate(spark, folder):
    return results.to_remediate(_findings(spark, folder)[1])


@query(
    FOUND + """, sizes AS (SELECT tab, row_count, col_count FROM t)
    SELECT 'table' AS section, tab AS name, 'rows' AS measure, CAST(row_count AS BIGINT) AS value FROM sizes
    UNION ALL SELECT 'table', tab, 'columns', CAST(col_count AS BIGINT) FROM sizes
    UNION ALL SELECT 'findings', 'all', 'high', count(*) FROM found WHERE NOT is_observation AND severity = 'HIGH'
    UNION ALL SELECT 'findings', 'all', 'medium', count(*) FROM found WHERE NOT is_observation AND severity = 'MEDIUM'
    UNION ALL SELECT 'findings', 'all', 'low', count(*) FROM found WHERE NOT is_observation AND severity = 'LOW'
    UNION ALL SELECT 'findings', 'all', 'observations', count(*) FROM found WHERE is_observation
    UNION ALL SELECT 'findings', 'all', 'to_remediate', count(*) FROM found
      WHERE NOT is_observation AND severity IN ('HIGH', 'MEDIUM')
    UNION ALL SELECT 'findings', 'all', 'drift', 0"""
)
def run_summary(spark, folder):
    """The numbers a run exports; its tables are compared with themselves, so there is no drift."""
    found, listed = _findings(spark, folder)
    expected = drift.schema_of(found.tables)
    events = drift.schema_drift(spark, expected, expected)
    return results.run_summary(found.table_profile, listed, events)


SNIPPED = ["dirty_orders", "dirty_orders_dups"]


def _sql_snippet(t: str, where: str, check: str, column: str | None) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c, _ in O.COLUMNS[t])
    name = f"'{column}'" if column else "NULL"
    return f"""SELECT '{check}' AS check_id, '{t}' AS "table", {name} AS "column",
      CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place, o_orderkey AS key_value,
      o_orderstatus AS status FROM {t} WHERE {where} ORDER BY {order} LIMIT 5"""


@query(
    O.with_clause(SNIPPED, *O.profiled(SNIPPED), O.FENCED.strip())
    + " UNION ALL ".join(
        f"SELECT * FROM ({s})" for s in (
            _sql_snippet("dirty_orders", "o_custkey IS NULL", "CHK-02", "o_custkey"),
            _sql_snippet("dirty_orders", "o_totalprice IS NULL", "CHK-03", "o_totalprice"),
            _sql_snippet("dirty_orders", "o_totalprice < 0", "CHK-12", "o_totalprice"),
            _sql_snippet(
                "dirty_orders",
                "o_totalprice < (SELECT lo FROM fences WHERE tab = 'dirty_orders' AND col = 'o_totalprice') "
                "OR o_totalprice > (SELECT hi FROM fences WHERE tab = 'dirty_orders' AND col = 'o_totalprice')",
                "CHK-11", "o_totalprice"),
            _sql_snippet("dirty_orders", f"o_orderdate > TIMESTAMP '{AS_OF}'", "CHK-D2", "o_orderdate"),
            _sql_snippet("dirty_orders_dups", "o_orderkey % 499 = 0", "CHK-05", None),
            _sql_snippet("dirty_orders_dups", "o_orderkey % 499 = 0", "CHK-06", "o_orderkey"),
        )
    )
)
def findings_snippets(spark, folder):
    found = profile(
        tables(spark, folder, SNIPPED), AS_OF, stages=("distinct", "quartiles", "gaps", "duplicates")
    )
    listed = checks.all_findings(found)
    return listed.select(
        "check_id", "table", "column", F.posexplode("snippet_rows").alias("place", "row")
    ).select(
        "check_id", "table", "column", (F.col("place") + 1).alias("place"),
        F.col("row")["o_orderkey"].cast("bigint").alias("key_value"),
        F.col("row")["o_orderstatus"].alias("status"),
    )


TASKS = """, issues AS (
  SELECT *, row_number() OVER (ORDER BY ordinal) AS number FROM advised WHERE NOT is_observation),
tasks AS (
  SELECT *, 'S-' || CASE WHEN number < 1000 THEN lpad(CAST(number AS VARCHAR), 3, '0')
    ELSE CAST(number AS VARCHAR) END AS id,
    CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS priority
  FROM (SELECT *, row_number() OVER (PARTITION BY category, tab, col ORDER BY number) AS nth
        FROM issues) WHERE nth = 1)
"""


#: What to do about a finding, by category; null where the hint is the suggestion itself.
HINT = """CASE
  WHEN category = 'REFERENTIAL'
    THEN 'split_mapped(' || tab || ', reference, [$' || coalesce(col, '') || '$]): keep the mapped rows, log the others'
  WHEN category = 'COMPLETENESS' AND col IS NOT NULL
    THEN 'forward_fill(' || tab || ', date, [$' || col || '$]) if the table is a series'
  WHEN category = 'INTEGRITY' AND lower(description) LIKE '%duplicate%'
    THEN 'keep_latest or flag_duplicates on [' || coalesce(col, 'all columns') || ']'
  WHEN category = 'OUTLIER'
    THEN 'flag_outliers(' || tab || ', [' || col || ']); average over rows flagged OK'
  WHEN category = 'TEMPORAL'
    THEN 'mark_reference_data on [' || coalesce(col, '') || ']; show rows without reference data apart'
  WHEN category = 'STRUCTURE'
    THEN 'do not load ' || tab || ' before its columns are confirmed' END""".replace("$", "''")


@query(
    FOUND + ADVISED + TASKS + """SELECT id, CAST(priority AS INTEGER) AS priority, severity, category,
      tab AS "table", affected AS affected_rows, description, suggestion AS action,
      coalesce(""" + HINT + """, suggestion) AS hint FROM tasks"""
)
def suggestions(spark, folder):
    return results.suggestions(_findings(spark, folder)[1])


@query(
    FOUND + ADVISED + TASKS + """SELECT CAST(i.number AS INTEGER) AS number, 'Open' AS status, i.severity,
      i.category, i.tab AS "table", coalesce(i.col, '—') AS "column", i.description AS issue, i.suggestion,
      coalesce((SELECT arg_max(coalesce(""" + HINT + """, suggestion), id) FROM tasks k WHERE k.description = i.description), '') AS hint
      FROM issues i"""
)
def quality_checklist(spark, folder):
    listed = _findings(spark, folder)[1]
    return results.checklist(listed, results.suggestions(listed))


@query(
    FOUND + """, cats AS (
      SELECT category, count(*) AS found, arg_min(severity, ordinal) AS severity,
        arg_min(is_observation, ordinal) AS observed FROM found GROUP BY category),
    registry(check_id, name, category) AS (VALUES """
    + ", ".join("({})".format(", ".join("'" + v.replace("'", "''") + "'" for v in entry))
                for entry in drift.K.CHECK_REGISTRY)
    + """)
    SELECT check_id, name, r.category, coalesce(c.found, 0) AS found,
      CASE WHEN c.found IS NULL THEN 'clean' WHEN observed THEN 'obs' ELSE lower(severity) END
        AS status FROM registry r LEFT JOIN cats c ON c.category = r.category"""
)
def checks_inventory(spark, folder):
    return results.checks_inventory(spark, _findings(spark, folder)[1])


DESCRIBED = ["orders", "part", "nation", "events", "transactions", "products", "fx"]


def _sql_samples(names) -> str:
    parts = [
        f"SELECT '{t}' AS tab, '{c}' AS col, (SELECT string_agg(v, ', ') FROM ("
        f"SELECT CAST({value} AS VARCHAR) AS v FROM {t} WHERE \"{c}\" IS NOT NULL "
        f"GROUP BY \"{c}\" ORDER BY \"{c}\" LIMIT 3)) AS samples"
        for t in names
        for c, kind in O.COLUMNS[t]
        for value in [f'CAST("{c}" AS TIMESTAMP)' if kind == O.D else f'"{c}"']
    ]
    return "samples AS (" + " UNION ALL ".join(parts) + ")"


@query(
    O.with_clause(DESCRIBED, *O.profiled(DESCRIBED), O.FENCED.strip(),
                  O.outlier_counts(DESCRIBED), _sql_samples(DESCRIBED))
    + """SELECT p.tab AS "table", p.col AS "column", typ AS inferred_type,
      CASE WHEN null_count > 0 THEN 'Yes' ELSE 'No' END AS nullable,
      format('{:.1f}', null_pct) || '%' AS null_pct, unique_count,
      format('{:.1f}', unique_pct) || '%' AS unique_pct,
      coalesce(CASE typ WHEN 'numeric' THEN format('{:,.4f}', num_min)
        WHEN 'date' THEN CAST(CAST(date_min AS DATE) AS VARCHAR) END, '—') AS min_value,
      coalesce(CASE typ WHEN 'numeric' THEN format('{:,.4f}', num_max)
        WHEN 'date' THEN CAST(CAST(date_max AS DATE) AS VARCHAR) END, '—') AS max_value,
      coalesce(s.samples, '') AS samples,
      concat_ws('; ', CASE WHEN pk THEN 'inferred PK' END, CASE WHEN fk THEN 'inferred FK' END,
        CASE WHEN o.outliers > 0 THEN o.outliers || ' outlier(s)' END,
        CASE WHEN typ IN ('id', 'categorical') AND row_count >= 15 AND unique_count > 20
          AND unique_count > row_count * 0.5 THEN 'high cardinality' END,
        CASE WHEN negative_count > 0 AND typ = 'numeric' THEN 'contains negatives' END) AS notes
      FROM p LEFT JOIN outl o USING (tab, col) LEFT JOIN samples s USING (tab, col)"""
)
def data_dictionary(spark, folder):
    found = profile(tables(spark, folder, DESCRIBED), AS_OF, stages=("distinct", "quartiles", "samples"))
    return results.data_dictionary(found.columns)


@query(
    O.with_clause(KEYED, *O.profiled(KEYED))
    + """SELECT count(DISTINCT tab) AS tables, count(*) AS total_columns,
      CAST(count_if(null_count > 0) AS BIGINT) AS nullable_columns FROM p"""
)
def dictionary_metadata(spark, folder):
    found = pin(facts.column_facts(tables(spark, folder, KEYED), (facts.NULLS,)))
    nullable = found.agg(F.count_if(F.col("null_count") > 0).alias("nullable_columns"))
    one = F.lit(1).alias("one")
    return results.dictionary_metadata(found).select("*", one).join(
        nullable.select("*", one), "one"
    ).drop("one")


# ---- remediation ---------------------------------------------------------------------


@query(
    O.with_clause(["fx"])
    + """SELECT "price-date", last_value(EURUSD IGNORE NULLS) OVER (ORDER BY "price-date"
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS EURUSD FROM fx"""
)
def remediate_ffill(spark, folder):
    return ordered.forward_fill(table(spark, folder, "fx"), "price-date", ["EURUSD"])


@query(
    O.with_clause(["dirty_orders"])
    + """SELECT o_orderkey, o_orderdate, last_value(o_totalprice IGNORE NULLS) OVER (
      ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS o_totalprice FROM dirty_orders"""
)
def remediate_ffill_rows(spark, folder):
    """A table with many rows per date; the order key breaks ties."""
    df = table(spark, folder, "dirty_orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ordered.forward_fill(df, "o_orderdate", ["o_totalprice"])


FLAGGED = ["products"]


@query(
    O.with_clause(FLAGGED, *O.profiled(FLAGGED), O.FENCED.strip())
    + """SELECT s.*, CASE WHEN "loan-property-value-ratio" < lo OR "loan-property-value-ratio" > hi
        THEN 'OUTLIER' ELSE 'OK' END AS "loan-property-value-ratio-quality-flag"
      FROM products s, (SELECT * FROM fences WHERE tab = 'products')"""
)
def remediate_flags(spark, folder):
    found = profile(tables(spark, folder, FLAGGED), stages=("quartiles",))
    return remediate.remediate(found.tables, found.rows)["products"]


@query(
    O.with_clause(["lineitems_coded", "parts_coded"])
    + """SELECT order_code, part_code, supplier_code,
      part_code IN (SELECT part_code FROM parts_coded) AS "is-mapped" FROM lineitems_coded"""
)
def remediate_unmapped(spark, folder):
    rows = table(spark, folder, "lineitems_coded").select("order_code", "part_code", "supplier_code")
    return remediate.mark_mapped(rows, table(spark, folder, "parts_coded"), ["part_code"])


@query(
    O.with_clause(["lineitems_coded", "parts_coded"])
    + """SELECT 'mapped' AS side, count(*) AS n, count(DISTINCT part_code) AS codes
      FROM lineitems_coded SEMI JOIN parts_coded USING (part_code)
    UNION ALL SELECT 'unmapped', count(*), count(DISTINCT part_code)
      FROM lineitems_coded ANTI JOIN parts_coded USING (part_code)"""
)
def remediate_split(spark, folder):
    mapped, unmapped = remediate.split_mapped(
        table(spark, folder, "lineitems_coded"), table(spark, folder, "parts_coded"), ["part_code"]
    )
    return union_all(
        df.groupBy("part_code").agg(F.count(F.lit(1)).alias("rows")).agg(
            F.lit(side).alias("side"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
            F.count(F.lit(1)).alias("codes"),
        ) for side, df in (("mapped", mapped), ("unmapped", unmapped))
    )


BASE_CODE = """regexp_replace("product-code", '-[0-9]{2}$', '')"""
VERSION = """CAST(coalesce(nullif(regexp_extract("product-code", '-([0-9]{2})$', 1), ''), '0')
  AS INTEGER)"""


def _versions(spark, folder):
    base, number = duplicates.split_version("product-code")
    return table(spark, folder, "versioned_parts").withColumns({"base": base, "version": number})


@query(
    O.with_clause(["versioned_parts"])
    + f"""SELECT "product-code", p_retailprice, base, version FROM (
      SELECT *, row_number() OVER (PARTITION BY base ORDER BY version DESC) AS nth FROM (
        SELECT *, {BASE_CODE} AS base, {VERSION} AS version FROM versioned_parts)) WHERE nth = 1"""
)
def remediate_keep_latest(spark, folder):
    return duplicates.keep_latest(_versions(spark, folder), ["base"], ["version"])


@query(
    O.with_clause(["versioned_parts"])
    + f"""SELECT "product-code", p_retailprice, base, version,
      count(*) OVER (PARTITION BY base) > 1 AS "is-duplicate",
      CASE WHEN version = max(version) OVER (PARTITION BY base) THEN 'LATEST' ELSE 'OLDER' END
        AS "version-flag"
      FROM (SELECT *, {BASE_CODE} AS base, {VERSION} AS version FROM versioned_parts)"""
)
def remediate_flag_dups(spark, folder):
    return duplicates.flag_duplicates(_versions(spark, folder), ["base"], "version")


@query(
    O.with_clause(["transactions", "fx"])
    + """SELECT t."transaction-code", t."transaction-date", f.EURUSD,
      f.EURUSD IS NOT NULL AS "has-reference-data"
      FROM transactions t LEFT JOIN fx f ON f."price-date" = t."transaction-date" """
)
def remediate_has_reference(spark, folder):
    rows = table(spark, folder, "transactions").select("transaction-code", "transaction-date")
    return remediate.mark_reference_data(
        rows, "transaction-date", table(spark, folder, "fx"), "price-date", "EURUSD"
    )


# ---- measures ------------------------------------------------------------------------

EXPOSURE = """exposure AS (
  SELECT CAST(nullif(round(sum(CAST("transaction-quantity" AS DECIMAL(18,4)) *
    CAST("transaction-price" AS DECIMAL(18,4))), 2), 0) AS DOUBLE) AS loan_exposure
  FROM transactions JOIN products USING ("product-code") WHERE "product-type" = 'LN')"""
VALUE = """last AS (SELECT max("transaction-date") AS d FROM transactions),
book AS (
  SELECT p."P1-EUR" * f.EURUSD + p."P2-USD" AS portfolio_value
  FROM last ASOF LEFT JOIN prices p ON last.d >= p."price-date"
  ASOF LEFT JOIN fx f ON last.d >= f."price-date")"""


@query(O.with_clause(["transactions", "products"], EXPOSURE) + "SELECT * FROM exposure")
def measure_exposure(spark, folder):
    return measures.loan_exposure(
        table(spark, folder, "transactions"), table(spark, folder, "products")
    )


@query(
    O.with_clause(["transactions", "prices", "fx"], VALUE)
    + "SELECT round(portfolio_value, 4) AS portfolio_value FROM book"
)
def measure_portfolio_value(spark, folder):
    book = tables(spark, folder, ["transactions", "prices", "fx"])
    return rounded(measures.portfolio_value(book["transactions"], book["prices"], book["fx"]))


@query(
    O.with_clause(["transactions", "products", "prices", "fx"], EXPOSURE, VALUE)
    + """SELECT round(loan_exposure / nullif(portfolio_value, 0), 4) AS loan_exposure_pct
      FROM exposure, book"""
)
def measure_exposure_pct(spark, folder):
    book = tables(spark, folder, ["transactions", "products", "prices", "fx"])
    return rounded(measures.loan_exposure_share(*book.values()))


@query(
    O.with_clause(["products"], *O.profiled(["products"]), O.FENCED.strip())
    + """SELECT round(avg(1.0 / "loan-property-value-ratio"), 4) AS avg_ltv,
      round(avg(1.0 / "loan-property-value-ratio") * 100, 4) AS avg_ltv_pct
      FROM products, (SELECT * FROM fences WHERE tab = 'products')
      WHERE "product-type" = 'LN' AND NOT ("loan-property-value-ratio" < lo
        OR "loan-property-value-ratio" > hi)"""
)
def measure_avg_ltv(spark, folder):
    found = profile(tables(spark, folder, ["products"]), stages=("quartiles",))
    row = next(r for r in found.rows if r["column"] == "loan-property-value-ratio")
    return rounded(
        measures.average_ltv(
            found.tables["products"], row.get("outlier_fence_lo"), row.get("outlier_fence_hi")
        )
    )


@query(
    O.with_clause(["transactions", "fx"])
    + """SELECT t."transaction-code", t."transaction-date", f.EURUSD
      FROM transactions t ASOF LEFT JOIN fx f ON t."transaction-date" >= f."price-date" """
)
def asof_rates(spark, folder):
    """The latest exchange rate on or before the date of every transaction."""
    rows = table(spark, folder, "transactions").select("transaction-code", "transaction-date")
    return ordered.asof_join(
        rows, "transaction-date", table(spark, folder, "fx"), "price-date", ["EURUSD"]
    )


# ---- sources and sinks ---------------------------------------------------------------


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_csv_roundtrip(spark, folder):
    """A table written as delimited text and loaded back by configuration; the header carries
    a byte order mark and spaces, one source is missing and one has an unknown type."""
    path = scratch(spark)
    given = table(spark, folder, "supplier")
    marked = given.toDF("﻿ s_suppkey", *[f"{c} " for c in given.columns[1:]])
    marked.write.csv(path, header=True, sep=";", escape='"')
    config = {
        "sources": {
            "supplier": {"file": path, "type": "csv", "delimiter": ";"},
            "absent": {"file": f"{path}-absent", "type": "csv"},
            "strange": {"file": path, "type": "workbook"},
        }
    }
    return catalog.load_tables(spark, config)["supplier"].select(
        "s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"), "s_acctbal"
    )


@query(
    O.with_clause(["fx"])
    + """SELECT "price-date", EURUSD FROM fx"""
)
def sink_cleaned(spark, folder):
    """Cleaned tables written per source in their own format and read back."""
    path = scratch(spark)
    sources = {"fx": {"type": "parquet", "file": "fx"}}
    sinks.write_cleaned({"fx": table(spark, folder, "fx")}, sources, path)
    return spark.read.parquet(f"{path}/cleaned_fx")


# text with quotes, delimiters, line breaks and spaces at both ends; the same formula on both sides
HARD_TEXT = (
    "concat('  ', text, ' ', CASE key % 4 WHEN 0 THEN concat('say \"', key, '\"; ') "
    "WHEN 1 THEN concat(key, chr(10), ' next; \"line\"', chr(10)) WHEN 2 THEN ';;\"' ELSE ', ' END, ' ')"
)


@query(
    f"""SELECT 'documents' AS source, CAST(doc_id AS BIGINT) AS key,
      {HARD_TEXT.replace('key', 'doc_id')} AS text FROM documents
    UNION ALL SELECT 'conversations', CAST(conv_id * 1000 + turn AS BIGINT),
      {HARD_TEXT.replace('key', 'turn')} FROM conversations"""
)
def sink_cleaned_text(spark, folder):
    """Whole texts, made harder by formula, written as delimited files and loaded back."""
    path = scratch(spark)
    docs = table(spark, folder, "documents").selectExpr(
        "doc_id AS key", f"{HARD_TEXT.replace('key', 'doc_id')} AS text"
    )
    turns = table(spark, folder, "conversations").selectExpr(
        "conv_id * 1000 + turn AS key", f"{HARD_TEXT.replace('key', 'turn')} AS text"
    )
    sources = {n: {"type": "csv", "file": n, "delimiter": ";"} for n in ("documents", "conversations")}
    sinks.write_cleaned({"documents": docs, "conversations": turns}, sources, path)
    config = {
        "sources": {n: c | {"file": f"{path}/cleaned_{n}"} for n, c in sources.items()}
    }
    loaded = catalog.load_tables(spark, config)
    return union_all(
        [df.select(F.lit(n).alias("source"), "key", "text") for n, df in loaded.items()]
    )


@query(
    O.with_clause(
        ["dirty_orders"], *O.related(["dirty_orders"]), O.table_counts(["dirty_orders"]),
        O.found(O.duplicate_keys(["dirty_orders"]), O.nulls(), O.negatives(), O.future_dates(),
                O.high_cardinality(), O.isolated()).strip(),
    )
    + """SELECT ordinal, severity, tab AS "table", coalesce(col, '—') AS "column", affected
      FROM found"""
)
def sink_results(spark, folder):
    """Findings written as JSON lines and read back."""
    path = scratch(spark)
    found = profile(tables(spark, folder, ["dirty_orders"]), AS_OF, stages=("distinct",))
    sinks.write_results(checks.all_findings(found, with_snippets=False), path)
    return spark.read.json(path).select("ordinal", "severity", "table", "column", "affected")


@query(
    FOUND
    + f""", have AS (SELECT t, c FROM {_sql_catalogue({n: [c for c, _ in O.COLUMNS[n]] for n in CHECKED})} x(t, c, i)),
      want AS (SELECT t, c FROM {_sql_catalogue(drift.K.EXPECTED_SCHEMA)} y(t, c, i)),
      filled AS (SELECT last_value(o_totalprice IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM dirty_orders),
      limits AS (SELECT lo, hi FROM fences WHERE tab = 'dirty_orders' AND col = 'o_totalprice')
      SELECT 'findings' AS result, count(*) AS n FROM found
      UNION ALL SELECT 'suggestions', (SELECT count(*) FROM (SELECT DISTINCT category, tab, col
        FROM found WHERE NOT is_observation))
      UNION ALL SELECT 'relationships', (SELECT count(*) FROM rel)
      UNION ALL SELECT 'columns', (SELECT count(*) FROM p)
      UNION ALL SELECT 'tables', (SELECT count(*) FROM t)
      UNION ALL SELECT 'cleaned rows', (SELECT count(*) FROM dirty_orders)
      UNION ALL SELECT 'cleaned nulls', (SELECT count(*) FROM filled WHERE price IS NULL)
      UNION ALL SELECT 'cleaned outliers', (SELECT count(*) FROM filled, limits WHERE price < lo OR price > hi)
      UNION ALL SELECT 'drift', (SELECT count(DISTINCT t) FROM want WHERE t NOT IN (SELECT t FROM have))
        + (SELECT count(*) FROM want WHERE t IN (SELECT t FROM have) AND (t, c) NOT IN (SELECT t, c FROM have))
        + (SELECT count(*) FROM have WHERE t IN (SELECT t FROM want) AND (t, c) NOT IN (SELECT t, c FROM want))
      UNION ALL SELECT 'unknown values', (SELECT count(DISTINCT "product-type") FROM products
        WHERE "product-type" NOT IN ('LN', 'EQ', 'FI', 'FX', 'CASH'))"""
)
def quality_run(spark, folder):
    """The whole run with snippets, samples, suggestions, drift, unknown values and a cleaned
    table whose fills and flags are counted."""
    run = run_quality(tables(spark, folder, CHECKED), CONFIG, AS_OF)
    cleaned = run.cleaned["dirty_orders"]
    return union_all(
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("result"), "n")
        for name, df in (
            ("findings", run.findings), ("suggestions", run.suggestions),
            ("relationships", run.relationships), ("columns", run.column_profile),
            ("tables", run.table_profile), ("cleaned rows", cleaned),
            ("cleaned nulls", cleaned.where("o_totalprice IS NULL")),
            ("cleaned outliers", cleaned.where("`o_totalprice-quality-flag` = 'OUTLIER'")),
            ("drift", run.drift), ("unknown values", run.unknown_values),
        )
    )
