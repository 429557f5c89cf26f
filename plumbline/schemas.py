"""Schemas of the result tables."""

COLUMN_PROFILE = """
    table string, column string, table_position int, position int, inferred_type string,
    row_count bigint, null_count bigint, null_pct double, unique_count bigint, unique_pct double,
    repeated_rows bigint, is_likely_pk boolean, is_likely_fk boolean,
    num_min double, num_max double, num_mean double, num_std double,
    num_q1 double, num_q3 double, num_iqr double,
    outlier_fence_lo double, outlier_fence_hi double, outlier_count bigint,
    has_negatives boolean, negative_count bigint,
    date_min timestamp_ntz, date_max timestamp_ntz,
    date_gaps bigint, date_future bigint, date_parse_fail bigint,
    top_values array<struct<value:string,count:bigint>>, cardinality_flag string,
    has_mixed_types boolean, has_encoding_issues boolean, encoding_count bigint,
    sample_values array<string>
"""

TABLE_PROFILE = """
    table string, table_position int, row_count bigint, col_count int, columns array<string>,
    likely_pk string, duplicate_rows bigint, duplicate_pk_rows bigint, fully_empty_rows bigint
"""

FINDINGS = """
    ordinal int, check_id string, severity string, category string, table string, column string,
    description string, affected bigint, examples array<string>, suggestion string,
    is_observation boolean, explanation string, snippet_rows array<map<string,string>>,
    stats map<string,string>
"""
