"""Oracle SQL: the same results computed by plain SQL on the same tables.

Everything here is SQL text for an engine with global windows and exact quantiles. It shares
no code with the operators beyond the definitions of the derived views and the fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable

from plumbline.workloads.views import AS_OF, oracle_views

N, D, S, X = "numeric", "date", "string", "other"

COLUMNS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", N), ("r_name", S)],
    "nation": [("n_nationkey", N), ("n_name", S), ("n_regionkey", N)],
    "customer": [("c_custkey", N), ("c_name", S), ("c_nationkey", N), ("c_acctbal", N),
                 ("c_mktsegment", S)],
    "supplier": [("s_suppkey", N), ("s_name", S), ("s_nationkey", N), ("s_acctbal", N)],
    "part": [("p_partkey", N), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", N),
             ("p_retailprice", N)],
    "orders": [("o_orderkey", N), ("o_custkey", N), ("o_orderstatus", S), ("o_totalprice", N),
               ("o_orderdate", D), ("o_orderpriority", S)],
    "lineitem": [("l_orderkey", N), ("l_partkey", N), ("l_suppkey", N), ("l_linenumber", N),
                 ("l_quantity", N), ("l_extendedprice", N), ("l_discount", N), ("l_tax", N),
                 ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", D)],
    "events": [("event_id", N), ("ts", D), ("user_id", N), ("event_type", S), ("value", N),
               ("props", S)],
    "documents": [("doc_id", N), ("text", S), ("lang", S), ("source", S), ("n_chars", N)],
    "embeddings": [("vec_id", N), ("embedding", X), ("label", N)],
    "pages": [("page_id", N), ("url", S), ("html", S)],
    "benchmark": [("item_id", N), ("text", S)],
    "labels": [("doc_id", N), ("quality", N), ("toxic", N)],
    "conversations": [("conv_id", N), ("turn", N), ("role", S), ("text", S)],
    "dirty_strings": [("o_orderkey", N), ("price_txt", S), ("date_txt", S), ("prio_txt", S)],
    "orders_coded": [("order_code", S), ("customer_code", S), ("o_orderstatus", S),
                     ("o_orderpriority", S), ("o_totalprice", N), ("o_orderdate", D)],
    "customers_coded": [("customer_code", S), ("nation_code", S), ("c_mktsegment", S)],
    "nations_coded": [("nation_code", S), ("n_name", S)],
    "suppliers_coded": [("supplier_code", S), ("nation_code", S)],
    "parts_coded": [("part_code", S), ("p_brand", S), ("p_type", S)],
    "lineitems_coded": [("order_code", S), ("part_code", S), ("supplier_code", S),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", D)],
    "fx": [("price-date", D), ("EURUSD", N)],
    "prices": [("price-date", D), ("P1-EUR", N), ("P2-USD", N)],
    "transactions": [("transaction-code", S), ("portfolio-code", S), ("product-code", S),
                     ("transaction-quantity", N), ("transaction-price", N),
                     ("transaction-date", D)],
    "products": [("product-code", S), ("product-type", S), ("product-currency", S),
                 ("product-issuer-code", S), ("loan-property-value-ratio", N)],
    "portfolios": [("portfolio-code", S), ("portfolio-currency", S)],
}
COLUMNS["dirty_orders"] = COLUMNS["dirty_orders_dups"] = COLUMNS["dirty_orders_empty"] = (
    COLUMNS["orders"]
)
COLUMNS["dirty_lineitem"] = COLUMNS["lineitem"]
COLUMNS["part_gap"] = COLUMNS["part"]

# fixed values: the patterns in the regular expression dialect of the oracle
NUMBER = r"^\s*(?:[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*$)"
DATE_FORM = (
    r"^\s*(?:\d{4}-\d{2}-\d{2}\s*$|\d{2}[./-]\d{2}[./-]\d{4}\s*$|\d{4}[./-]\d{2}[./-]\d{2})"
)
ID_FORM = r"^\s*(?:[A-Z]{2,4}-[A-Z0-9]{4,}|[A-Z0-9]+-\d+\s*$|\d{6,}\s*$|[A-F0-9]{8}-)"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{fffd}]"
FORMATS = "['%Y-%m-%d', '%d/%m/%Y', '%d.%m.%Y', '%d-%m-%Y', '%Y/%m/%d']"

DAY_US = 86_400_000_000


def with_clause(views: Iterable[str], *ctes: str) -> str:
    parts = oracle_views(views) + [c for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def number(column: str, kind: str) -> str:
    if kind == N:
        return f'CAST("{column}" AS DOUBLE)'
    if kind == S:
        return (
            f"CASE WHEN regexp_matches(\"{column}\", '{NUMBER}') "
            f"THEN TRY_CAST(trim(\"{column}\") AS DOUBLE) END"
        )
    return "CAST(NULL AS DOUBLE)"


def moment(column: str, kind: str) -> str:
    if kind == D:
        return f'CAST("{column}" AS TIMESTAMP)'
    if kind == S:
        return f'try_strptime(trim("{column}"), {FORMATS})'
    return "CAST(NULL AS TIMESTAMP)"


def _text(test: str, kind: str) -> str:
    return test if kind == S else "CAST(NULL AS BIGINT)"


def raw_columns(names: Iterable[str]) -> str:
    """CTE raw: counts, statistics and text tests of every column."""
    parts = []
    for tpos, name in enumerate(names):
        for pos, (c, kind) in enumerate(COLUMNS[name]):
            q, num, ts = f'"{c}"', number(c, kind), moment(c, kind)
            unique = f"count(DISTINCT {q})" if kind != X else "CAST(NULL AS BIGINT)"
            again = (
                f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {name} "
                f"WHERE {q} IS NOT NULL GROUP BY {q} HAVING count(*) > 1))"
            ) if kind != X else "CAST(NULL AS BIGINT)"
            parts.append(f"""
        SELECT '{name}' AS tab, '{c}' AS col, {tpos} AS tpos, {pos} AS pos, '{kind}' AS kind,
          count(*) AS row_count, count(*) - count({q}) AS null_count,
          {unique} AS unique_count, {again} AS repeated_rows,
          {_text(f"count_if(regexp_matches({q}, '{CONTROL}'))", kind)} AS enc,
          {_text(f"count_if(regexp_matches({q}, '{DATE_FORM}'))", kind)} AS date_pattern,
          {_text(f"count({ts})", kind)} AS date_value,
          {_text(f"count({num})", kind)} AS number_value,
          {_text(f"count_if(regexp_matches({q}, '{ID_FORM}'))", kind)} AS id_pattern,
          min({num}) AS num_min, max({num}) AS num_max, avg({num}) AS num_mean,
          stddev_samp({num}) AS num_std,
          quantile_cont({num}, 0.25) AS q1, quantile_cont({num}, 0.75) AS q3,
          count_if({num} < 0) AS negative_count,
          min({ts}) AS date_min, max({ts}) AS date_max,
          CAST(count_if({ts} > TIMESTAMP '{AS_OF}') AS BIGINT) AS date_future
        FROM {name}""")
    return "raw AS (" + "\n UNION ALL ".join(parts) + ")"


# CTEs cols and p: types, hints and keys by the rules of the first match
TYPED = """
cols AS (
  SELECT *,
    CASE WHEN row_count = 0 THEN 0.0
         ELSE round_even(null_count::DOUBLE / row_count::DOUBLE * 100, 2) END AS null_pct,
    CASE WHEN row_count = 0 THEN 0.0
         ELSE round_even(unique_count::DOUBLE / row_count::DOUBLE * 100, 2) END AS unique_pct,
    CASE WHEN kind IN ('date', 'numeric') THEN kind
         WHEN kind <> 'string' OR row_count = null_count THEN 'text'
         WHEN date_pattern / (row_count - null_count)::DOUBLE > 0.7
          AND date_value / (row_count - null_count)::DOUBLE > 0.7 THEN 'date'
         WHEN number_value / (row_count - null_count)::DOUBLE > 0.85 THEN 'numeric'
         WHEN id_pattern / (row_count - null_count)::DOUBLE > 0.6 THEN 'id'
         WHEN unique_count / (row_count - null_count)::DOUBLE < 0.3
           OR unique_count <= 30 THEN 'categorical'
         ELSE 'text' END AS typ
  FROM raw),
scored AS (
  SELECT *,
    coalesce(unique_pct < 80 AND regexp_matches(lower(col), 'code|id|key|ref|type'), false) AS fk,
    CASE WHEN row_count >= 5 AND null_count = 0 AND unique_pct >= 99 THEN
      CASE WHEN regexp_matches(lower(col), 'code|id|key|ref|number|num') THEN 3 ELSE 0 END +
      CASE WHEN typ IN ('id', 'categorical') THEN 2 ELSE 0 END +
      CASE WHEN pos = 0 THEN 1 ELSE 0 END END AS score
  FROM cols),
p AS (
  SELECT * EXCLUDE (num_min, num_max, q1, q3),
    score IS NOT NULL AND row_number() OVER (
      PARTITION BY tab ORDER BY score DESC NULLS LAST, pos) = 1 AS pk,
    regexp_matches(lower(col), 'quantity|qty|volume|units') AS flow,
    regexp_matches(lower(col), 'price|value|ratio|rate|amount|volume|pct') AS positive,
    CASE WHEN typ = 'numeric' AND kind = 'string' THEN row_count - null_count - number_value
         ELSE 0 END AS unparsed,
    CASE WHEN typ = 'date' AND kind = 'string' THEN row_count - null_count - date_value
         ELSE 0 END AS date_fail,
    round(num_min, 6) AS num_min, round(num_max, 6) AS num_max,
    round(q1, 6) AS q1, round(q3, 6) AS q3,
    round(round(q3, 6) - round(q1, 6), 6) AS iqr
  FROM scored)
"""

FENCED = """
fences AS (
  SELECT tab, col, round(q1 - 3 * iqr, 6) AS lo, round(q3 + 3 * iqr, 6) AS hi
  FROM p WHERE typ = 'numeric' AND iqr > 0)
"""


def quartiles(names: Iterable[str]) -> str:
    """CTE p of columns that are numbers by type, with just what outliers need."""
    parts = [
        f"SELECT '{name}' AS tab, '{c}' AS col, {tpos} AS tpos, {pos} AS pos, 'numeric' AS typ, "
        f"count(*) AS row_count, round(quantile_cont({number(c, N)}, 0.25), 6) AS q1, "
        f"round(quantile_cont({number(c, N)}, 0.75), 6) AS q3 FROM {name}"
        for tpos, name in enumerate(names)
        for pos, (c, kind) in enumerate(COLUMNS[name])
        if kind == N
    ]
    return (
        f"quarts AS ({' UNION ALL '.join(parts)}), p AS (SELECT *, round(q3 - q1, 6) AS iqr, "
        "regexp_matches(lower(col), 'quantity|qty|volume|units') AS flow FROM quarts)"
    )


def outlier_counts(names: Iterable[str], of_kinds: tuple = ()) -> str:
    """CTE outl: values outside the fences per numeric column."""
    parts = [
        f"SELECT f.tab, f.col, any_value(f.lo) AS lo, any_value(f.hi) AS hi, "
        f"count_if({number(c, kind)} < f.lo OR {number(c, kind)} > f.hi) AS outliers "
        f"FROM {name} JOIN fences f ON f.tab = '{name}' AND f.col = '{c}' GROUP BY ALL"
        for name in names
        for c, kind in COLUMNS[name]
        if kind in (of_kinds or (N, S))
    ]
    return "outl AS (" + "\n UNION ALL ".join(parts) + ")"


def gap_counts(names: Iterable[str], text: bool = False) -> str:
    """CTE gaps: gap count per date column by the global order of all its dates."""
    monday = "date_diff('day', DATE '1970-01-05', CAST({} AS DATE))"

    def weekdays(e: str) -> str:
        k = monday.format(e)
        return f"(floor({k} / 7.0) * 5 + least((({k} % 7) + 7) % 7, 5))"

    parts = []
    for name in names:
        for c, kind in COLUMNS[name]:
            if kind != D and not (text and kind == S):
                continue
            parts.append(f"""
        SELECT '{name}' AS tab, '{c}' AS col,
          CAST(CASE WHEN count(ts) <= 5 OR any_value(med) IS NULL OR any_value(med) <= 0 THEN 0
               WHEN any_value(med) <= 2 * {DAY_US}
                 THEN count_if({weekdays('ts')} - {weekdays('prev')} > 1)
               ELSE count_if(diff > 3 * med) END AS BIGINT) AS gaps
        FROM (SELECT *, quantile_cont(diff, 0.5) OVER () AS med FROM (
          SELECT ts, prev, epoch_us(ts) - epoch_us(prev) AS diff FROM (
            SELECT ts, lag(ts) OVER (ORDER BY ts) AS prev
            FROM (SELECT {moment(c, kind)} AS ts FROM {name}) WHERE ts IS NOT NULL)))""")
    if not parts:
        return "gaps AS (SELECT '' AS tab, '' AS col, 0 AS gaps WHERE false)"
    return "gaps AS (" + "\n UNION ALL ".join(parts) + ")"


def table_counts(names: Iterable[str], duplicates: bool = False) -> str:
    """CTE t: rows, columns, empty rows and (on request) duplicate rows per table."""
    parts = []
    for tpos, name in enumerate(names):
        columns = [c for c, _ in COLUMNS[name]]
        empty = " AND ".join(f'"{c}" IS NULL' for c in columns)
        listed = ", ".join(f"'{c}'" for c in columns)
        copies = (
            f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {name} GROUP BY ALL "
            f"HAVING count(*) > 1))"
        )
        grouped = ", ".join(f'"{c}"' for c in columns)
        copies = copies.replace("SELECT count(*) AS n FROM", f"SELECT {grouped}, count(*) AS n FROM")
        parts.append(
            f"SELECT '{name}' AS tab, {tpos} AS tpos, count(*) AS row_count, "
            f"{len(columns)} AS col_count, [{listed}] AS columns, "
            f"count_if({empty}) AS empty_rows, "
            f"{copies if duplicates else 0} AS duplicate_rows FROM {name}"
        )
    return "t AS (" + "\n UNION ALL ".join(parts) + ")"


def histogram(names: Iterable[str], integer_keys: bool = False) -> str:
    """CTE hist: value counts of the key and category columns."""
    parts = [
        f"SELECT '{name}' AS tab, '{c}' AS col, CAST(\"{c}\" AS VARCHAR) AS value, count(*) AS n "
        f"FROM {name} WHERE \"{c}\" IS NOT NULL GROUP BY \"{c}\""
        for name in names
        for c, kind in COLUMNS[name]
        if kind == S or integer_keys and kind == N and any(w in c for w in ("id", "key"))
    ]
    return "allhist AS (" + "\n UNION ALL ".join(parts) + """),
hist AS (SELECT h.* FROM allhist h JOIN p USING (tab, col) WHERE p.typ IN ('id', 'categorical'))"""


def similarity(a: str, b: str) -> str:
    left = f"list_distinct(regexp_split_to_array(lower({a}), '[-_\\s]'))"
    right = f"list_distinct(regexp_split_to_array(lower({b}), '[-_\\s]'))"
    return (
        f"len(list_intersect({left}, {right}))::DOUBLE / "
        f"len(list_distinct(list_concat({left}, {right})))"
    )


RELATED = f"""
pairs AS (
  SELECT a.tab AS t1, a.col AS c1, b.tab AS t2, b.col AS c2, count(*) AS overlap,
    sum(a.n) AS overlap_rows
  FROM hist a JOIN hist b ON a.value = b.value AND a.tab <> b.tab
  GROUP BY ALL),
looked AS (
  SELECT x.*, {similarity('c1', 'c2')} AS nm, p1.tpos AS tp1, p1.pos AS cp1,
    p2.tpos AS tp2, p2.pos AS cp2, p1.typ AS typ,
    p1.unique_pct AS u1, p2.unique_pct AS u2, p1.unique_count AS k1, p2.unique_count AS k2,
    p1.row_count - p1.null_count AS rows1,
    overlap::DOUBLE / p1.unique_count * 100 AS pct1,
    overlap::DOUBLE / p2.unique_count * 100 AS pct2
  FROM pairs x JOIN p p1 ON p1.tab = t1 AND p1.col = c1
  JOIN p p2 ON p2.tab = t2 AND p2.col = c2 WHERE p1.typ = p2.typ),
-- every ordered pair is looked at once; the side with more distinct values becomes the target
passed AS (
  SELECT *, u1 > u2 AS swapped FROM looked
  WHERE pct1 >= 5 AND (pct1 >= 20 OR nm >= 0.5)),
directed AS (
  SELECT tp1 AS o0, tp2 AS o1, cp1 AS o2, cp2 AS o3, nm, typ,
    CASE WHEN swapped THEN t2 ELSE t1 END AS ft, CASE WHEN swapped THEN c2 ELSE c1 END AS fc,
    CASE WHEN swapped THEN t1 ELSE t2 END AS tt, CASE WHEN swapped THEN c1 ELSE c2 END AS tc,
    CASE WHEN swapped THEN pct2 ELSE pct1 END AS pct
  FROM passed),
rel AS (
  SELECT d.*, l.k1 - l.overlap AS orphan_values, l.rows1 - l.overlap_rows AS orphan_rows,
    CASE WHEN pct >= 80 AND d.nm >= 0.7 THEN 'HIGH' WHEN pct >= 95 THEN 'HIGH'
         WHEN pct >= 50 OR d.nm >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
    concat_ws(' + ',
      CASE WHEN d.nm >= 0.5
        THEN 'column names similar (' || format('{{:,.0f}}', d.nm * 100) || '%)' END,
      CASE WHEN pct > 0 THEN format('{{:,.0f}}', pct) || '% of values overlap' END) AS reason
  FROM (SELECT *, row_number() OVER (
          PARTITION BY ft, fc, tt, tc ORDER BY o0, o1, o2, o3) AS nth FROM directed) d
  JOIN looked l ON l.t1 = d.ft AND l.c1 = d.fc AND l.t2 = d.tt AND l.c2 = d.tc
  WHERE nth = 1)
"""

# ---- findings: SELECTs with the same columns, to be combined with UNION ALL ------------------

FIELDS = (
    "stage, o0, o1, o2, o3, step, check_id, severity, category, tab, col, description, "
    "affected, is_observation, examples"
)


def _finding(
    source: str, where: str, step: int, check_id: str, severity: str, category: str,
    description: str, affected: str, col: str = "col", stage: int = 0,
    place: str = "tpos AS o0, pos AS o1, 0 AS o2, 0 AS o3", observed: str = "false",
    examples: str = "''",
) -> str:
    return (
        f"SELECT {stage} AS stage, {place}, {step} AS step, {check_id} AS check_id, "
        f"{severity} AS severity, '{category}' AS category, tab, {col} AS col, "
        f"{description} AS description, CAST({affected} AS BIGINT) AS affected, "
        f"{observed} AS is_observation, {examples} AS examples FROM {source} WHERE {where}"
    )


TABLE_PLACE = "tpos AS o0, -1 AS o1, 0 AS o2, 0 AS o3"


def empty_rows() -> str:
    return _finding("t", "empty_rows > 0", 0, "'CHK-04'", "'HIGH'", "COMPLETENESS",
                    "empty_rows || ' fully empty row(s) found'", "empty_rows", col="NULL",
                    place=TABLE_PLACE)


def duplicate_rows() -> str:
    return _finding("t", "duplicate_rows > 0", 1, "'CHK-05'", "'MEDIUM'", "INTEGRITY",
                    "CAST(duplicate_rows AS BIGINT) || ' fully duplicate row(s) detected'",
                    "duplicate_rows", col="NULL", place=TABLE_PLACE)


def duplicate_keys(names: Iterable[str]) -> str:
    examples = "CASE " + " ".join(
        f"WHEN tab = '{name}' AND col = '{c}' THEN (SELECT string_agg(CAST(k AS VARCHAR), '|' "
        f"ORDER BY k) FROM (SELECT \"{c}\" AS k FROM {name} GROUP BY 1 HAVING count(*) > 1 "
        f"ORDER BY 1 LIMIT 5))"
        for name in names for c, kind in COLUMNS[name] if kind in (N, S)
    ) + " ELSE '' END"
    rows = "(repeated_rows + CASE WHEN null_count > 1 THEN null_count ELSE 0 END)::BIGINT"
    return _finding("p", f"pk AND {rows} > 0 AND row_count >= 10", 2, "'CHK-06'", "'HIGH'",
                    "INTEGRITY",
                    f"{rows} || ' rows share a duplicate inferred primary key [' || col || ']'",
                    rows, place=TABLE_PLACE, examples=examples)


def nulls() -> str:
    return _finding(
        "p", "null_count > 0", 3,
        "CASE WHEN pk THEN 'CHK-01' WHEN fk THEN 'CHK-02' ELSE 'CHK-03' END",
        "CASE WHEN pk THEN 'HIGH' WHEN fk THEN 'MEDIUM' ELSE 'LOW' END", "COMPLETENESS",
        "null_count || ' null(s) in [' || col || '] (' || format('{:.1f}', null_pct) "
        "|| '% of rows)'", "null_count")


def outliers() -> str:
    return _finding(
        "(SELECT * FROM p JOIN outl USING (tab, col))", "outliers > 0", 4,
        "CASE WHEN flow THEN 'CHK-16' ELSE 'CHK-11' END",
        "CASE WHEN NOT flow AND outliers::DOUBLE / row_count > 0.05 THEN 'MEDIUM' ELSE 'LOW' END",
        "OUTLIER",
        "outliers || ' statistical outlier(s) in [' || col || '] (3×IQR fence: [' || "
        "format('{:,.4f}', lo) || ' → ' || format('{:,.4f}', hi) || '])'", "outliers",
        observed="flow")


def negatives() -> str:
    return _finding(
        "p", "typ = 'numeric' AND negative_count > 0 AND NOT flow AND positive", 5, "'CHK-12'",
        "'MEDIUM'", "INTEGRITY",
        "negative_count || ' negative value(s) in [' || col || '] — unexpected for this field'",
        "negative_count")


def unparsed_dates() -> str:
    return _finding(
        "p", "date_fail > 0", 6, "'CHK-D1'", "'HIGH'", "COMPLETENESS",
        "date_fail || ' value(s) in [' || col || '] could not be parsed as dates'", "date_fail")


def future_dates() -> str:
    return _finding(
        "p", "typ = 'date' AND date_future > 0", 7, "'CHK-D2'", "'MEDIUM'", "INTEGRITY",
        "date_future || ' future date(s) in [' || col || ']'", "date_future")


def date_gaps() -> str:
    return _finding(
        "(SELECT * FROM p JOIN gaps USING (tab, col))", "typ = 'date' AND gaps > 3", 8,
        "'CHK-15'", "'LOW'", "TEMPORAL",
        "gaps || ' business-day gap(s) in date sequence of [' || col || ']'", "gaps")


def mixed_types() -> str:
    return _finding(
        "p", "unparsed > 0", 9, "'CHK-10'", "'HIGH'", "STRUCTURE",
        "'[' || col || '] contains mixed types — some values cannot be parsed as ' || typ", "0")


def high_cardinality() -> str:
    return _finding(
        "p", "typ = 'categorical' AND NOT pk AND row_count >= 15 AND unique_count > 20 "
        "AND unique_count > row_count * 0.5", 10, "'CHK-07'", "'LOW'", "INTEGRITY",
        "'[' || col || '] has high cardinality (' || unique_count || ' unique values) for a "
        "categorical field'", "0")


def encoding() -> str:
    return _finding(
        "p", "enc > 0", 11, "'X8'", "'HIGH'", "STRUCTURE",
        "enc || ' value(s) in [' || col || '] contain control or replacement characters'", "enc")


def orphans() -> str:
    examples = (
        "(SELECT string_agg(value, '|' ORDER BY value) FROM (SELECT value FROM hist h WHERE "
        "h.tab = ft AND h.col = fc AND NOT EXISTS (SELECT 1 FROM hist g WHERE g.tab = tt AND "
        "g.col = tc AND g.value = h.value) ORDER BY value LIMIT 5))"
    )
    return _finding(
        "(SELECT *, ft AS tab, fc AS col FROM rel)",
        "confidence IN ('HIGH', 'MEDIUM') AND orphan_values > 0", 0,
        "CASE WHEN confidence = 'HIGH' THEN 'CHK-13' ELSE 'CHK-14' END", "confidence",
        "REFERENTIAL",
        "CAST(orphan_rows AS BIGINT) || ' value(s) in [' || ft || '.' || fc || '] not found in [' "
        "|| tt || '.' || tc || '] — ' || orphan_values || ' orphaned codes'", "orphan_rows",
        stage=1, place="o0, o1, o2, o3", examples=examples)


WIDEST = """
ranges AS (
  SELECT *, floor(epoch(date_max - date_min) / 86400) AS span FROM p
  WHERE typ = 'date' AND date_min IS NOT NULL AND date_max IS NOT NULL),
widest AS (
  SELECT tab AS rtab, col AS rcol, date_min AS rmin, date_max AS rmax FROM ranges
  ORDER BY span DESC, tpos, pos LIMIT 1),
coverage AS (
  SELECT *, CAST(floor(epoch(date_min - rmin) / 86400) AS BIGINT) AS start_gap,
    CAST(floor(epoch(rmax - date_max) / 86400) AS BIGINT) AS end_gap
  FROM ranges, widest WHERE NOT (tab = rtab AND col = rcol))
"""


def coverage() -> str:
    day = "CAST(CAST({} AS DATE) AS VARCHAR)"
    parts = []
    for step, (check, where, verb, own, other, reference, gap) in enumerate((
        ("CHK-17", "date_min > rmin", "starts", "date_min", "goes back to", "rmin", "start_gap"),
        ("CHK-18", "date_max < rmax", "ends", "date_max", "goes up to", "rmax", "end_gap"),
    )):
        parts.append(_finding(
            "coverage", where, step, f"'{check}'", "'LOW'", "TEMPORAL",
            f"'[' || tab || '.' || col || '] {verb} ' || {day.format(own)} || ' — [' || rtab || "
            f"'.' || rcol || '] {other} ' || {day.format(reference)} || ' (' || {gap} || "
            f"'-day gap)'", "0", stage=2, observed="true"))
    return " UNION ALL ".join(parts)


def isolated() -> str:
    dates = "(SELECT string_agg(col, ', ' ORDER BY pos) FROM p WHERE p.tab = t.tab AND typ = 'date')"
    return _finding(
        "t", "tab NOT IN (SELECT ft FROM rel WHERE confidence <> 'LOW' UNION ALL "
        "SELECT tt FROM rel WHERE confidence <> 'LOW')", 0, "'CHK-19'", "'LOW'", "ARCHITECTURE",
        "'[' || tab || '] has no direct key relationship to other tables' || "
        f"coalesce(' — date column(s) [' || {dates} || '] suggest as-of date logic is required', '')",
        "0", col="NULL", stage=3, place="tpos AS o0, 0 AS o1, 0 AS o2, 0 AS o3", observed="true")


def rule_values(index: int, rule: dict) -> str:
    """An allowed-values rule."""
    name, c = rule["applies_to"], rule["column"]
    allowed = ", ".join(f"'{v}'" for v in rule["values"])
    return (
        f"SELECT 4 AS stage, {index} AS o0, 0 AS o1, 0 AS o2, 0 AS o3, 0 AS step, "
        f"'CHK-08' AS check_id, 'LOW' AS severity, 'INTEGRITY' AS category, '{name}' AS tab, "
        f"'{c}' AS col, '[{rule['id']}] [{c}] has ' || count(*) || ' value(s) outside the allowed "
        f"set, listed in [unknown_values]' AS description, "
        f"CAST(sum(n) AS BIGINT) AS affected, false AS is_observation, "
        f"array_to_string(list_slice(list(v ORDER BY v), 1, 5), '|') AS examples "
        f"FROM (SELECT \"{c}\" AS v, count(*) AS n FROM {name} WHERE \"{c}\" IS NOT NULL "
        f"AND \"{c}\" NOT IN ({allowed}) GROUP BY 1) HAVING count(*) > 0"
    )


def rule_column(index: int, rule: dict) -> str:
    """A required-column rule; names are known, so only the row count is read."""
    name, c = rule["applies_to"], rule["column"]
    known = ", ".join(f"'{k}'" for k, _ in COLUMNS[name])
    return (
        f"SELECT 4 AS stage, {index} AS o0, 0 AS o1, 0 AS o2, 0 AS o3, 0 AS step, "
        f"'CHK-09' AS check_id, 'HIGH' AS severity, 'STRUCTURE' AS category, '{name}' AS tab, "
        f"'{c}' AS col, '[{rule['id']}] [{name}] lacks the column [{c}] that a rule calls for' "
        f"AS description, count(*) AS affected, false AS is_observation, '' AS examples "
        f"FROM {name} WHERE '{c}' NOT IN ({known}) HAVING count(*) > 0"
    )


def rule_range(index: int, rule: dict) -> str:
    name, c = rule["applies_to"], rule["column"]
    outside = f"\"{c}\" < {rule['min']} OR \"{c}\" > {rule['max']}"
    return (
        f"SELECT 4 AS stage, {index} AS o0, 0 AS o1, 0 AS o2, 0 AS o3, 0 AS step, "
        f"'X6' AS check_id, 'LOW' AS severity, 'INTEGRITY' AS category, '{name}' AS tab, "
        f"'{c}' AS col, '[{rule['id']}] [{c}] has ' || count(*) || ' value(s) outside "
        f"[{rule['min']}, {rule['max']}]' AS description, count(*) AS affected, "
        f"false AS is_observation, '' AS examples FROM {name} WHERE {outside} HAVING count(*) > 0"
    )


def found(*selects: str) -> str:
    """CTE found: all findings with their ordinal."""
    return f"""
listed AS ({" UNION ALL ".join(f"SELECT {FIELDS} FROM ({s})" for s in selects)}),
found AS (
  SELECT *, row_number() OVER (ORDER BY is_observation,
    CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END,
    stage, o0, o1, o2, o3, step) AS ordinal
  FROM listed)"""


SHOWN = (
    'check_id, severity, category, tab AS "table", col AS "column", description, affected'
)


def check(names: list[str], select: str, *extra: str) -> str:
    """Oracle of a single check over some tables."""
    return with_clause(names, *extra) + f"SELECT {SHOWN} FROM ({select})"


def profiled(names: list[str]) -> tuple[str, ...]:
    return (raw_columns(names), TYPED.strip())


def related(names: list[str], integer_keys: bool = False) -> tuple[str, ...]:
    raw, typed = profiled(names)
    if integer_keys:  # of the given tables, only whole numbers have such names
        typed = typed.replace(
            "CASE WHEN kind IN ('date', 'numeric') THEN kind",
            "CASE WHEN kind = 'numeric' AND regexp_matches(lower(col), 'id|key') THEN 'id'\n"
            "         WHEN kind IN ('date', 'numeric') THEN kind",
        )
    return (raw, typed, histogram(names, integer_keys), RELATED.strip())
