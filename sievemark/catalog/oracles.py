"""The same queries as SQL, one rule at a time and joined up, for an independent check."""

from __future__ import annotations

from .files import FILE_ORACLES
from .raw_orders import COLUMNS, RAW_ORDERS_SQL

_COMPARED = ", ".join(COLUMNS[1:])
_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def _issue(rule: str, column: str, message: str, where: str, **other: str) -> str:
    severity, value = other.get("severity", "error"), other.get("value", column)
    rule_id = rule if rule.startswith("CASE") else f"'{rule}'"
    text = message if message.startswith(("CASE", "concat")) else f"'{message}'"
    return f"""
  SELECT batch_year, source_row_number, record_id, {rule_id} AS rule_id,
         '{other.get("named", column)}' AS "column", {value} AS value, {text} AS message,
         '{severity}' AS severity
  FROM {other.get("source", "checked")} WHERE {where}"""


_ROW_ISSUES = [
    _issue(
        "CASE WHEN event_date = '' THEN 'inspection_date_required' "
        "WHEN day IS NULL THEN 'inspection_date_format' "
        "ELSE 'inspection_year_matches_filename' END",
        "event_date",
        "CASE WHEN event_date = '' THEN 'Inspection date is required.' "
        "WHEN day IS NULL THEN 'Inspection date does not match an accepted format.' "
        "ELSE concat('Inspection year ', year(day), ' does not match batch year ', "
        "batch_year, '.') END",
        "event_date = '' OR day IS NULL OR year(day) <> batch_year",
    ),
    _issue("inspection_result_required", "result", "Inspection result is required.", "result = ''"),
    _issue(
        "inspection_result_allowed_values",
        "result",
        "Inspection result is not an allowed value.",
        "result NOT IN ('', 'O', 'F', 'P')",
    ),
    _issue(
        "coordinate_pair_consistency",
        "latitude",
        "Latitude and longitude must both be present or both be null.",
        "(latitude = '') <> (longitude = '')",
        named="latitude,longitude",
        value="concat('latitude=''', latitude, '''; longitude=''', longitude, '''')",
    ),
    *[
        _issue(
            f"{name}_numeric",
            name,
            f"{name.capitalize()} must be a finite number.",
            f"{name} <> '' AND {name[:3]} IS NULL",
        )
        for name in ("latitude", "longitude")
    ],
    *[
        _issue(
            f"{name}_range",
            name,
            f"{name.capitalize()} must be between -{bound} and {bound}.",
            f"{name} <> '' AND abs({name[:3]}) > {bound}",
        )
        for name, bound in (("latitude", 90), ("longitude", 180))
    ],
    *[
        _issue(
            f"{name}_pattern",
            name,
            f"{name} does not match the required pattern.",
            f"{name} <> '' AND NOT regexp_full_match({name}, '{pattern}')",
        )
        for name, pattern in (("state", "[A-Z]{2}"), ("zip", "[0-9]{5}"))
    ],
    _issue(
        "license_digits",
        "license",
        "license must contain digits only.",
        "license <> '' AND NOT regexp_full_match(license, '[0-9]+')",
    ),
    _issue(
        "license_zero_sentinel",
        "license",
        "license uses the zero sentinel and will be normalized to null.",
        "regexp_full_match(license, '0+')",
        severity="warning",
    ),
    _issue("risk_missing", "risk", "risk is missing.", "risk = ''", severity="warning"),
    _issue(
        "risk_unknown",
        "risk",
        "risk is not an allowed risk value.",
        "risk NOT IN ('', '1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')",
        severity="warning",
    ),
]

_ID_ISSUE = _issue(
    "CASE WHEN true THEN id_rule END",
    "record_id",
    """CASE id_rule WHEN 'inspection_id_required' THEN 'Inspection ID is required.'
      WHEN 'inspection_id_format' THEN 'Inspection ID must contain digits only.'
      WHEN 'inspection_id_int64' THEN 'Inspection ID cannot be represented as int64.'
      WHEN 'inspection_id_minimum' THEN 'Inspection ID must be greater than or equal to 1.'
      ELSE concat('Inspection ID ', number, ' appears more than once in the batch.') END""",
    "id_rule IS NOT NULL",
    source="identified",
)

_DUPLICATE_ISSUE = """
  SELECT batch_year, source_row_number, cast(number AS varchar) AS record_id,
         'exact_duplicate_record' AS rule_id, 'record_id' AS "column",
         cast(number AS varchar) AS value,
         concat('Record is an exact duplicate of record_id ', kept, '.') AS message,
         'error' AS severity
  FROM copies"""

_CHECKED = rf"""
WITH {RAW_ORDERS_SQL}, checked AS (
  SELECT *,
    CASE WHEN regexp_full_match(record_id, '[0-9]+') THEN try_cast(record_id AS bigint) END
      AS number,
    cast(try_strptime(event_date, '%Y-%m-%dT%H:%M:%S.%g') AS date) AS day,
    CASE WHEN regexp_full_match(latitude, '{_NUMBER}') THEN try_cast(latitude AS double) END AS lat,
    CASE WHEN regexp_full_match(longitude, '{_NUMBER}') THEN try_cast(longitude AS double) END
      AS lon
  FROM raw_orders
), numbered AS (
  SELECT *, CASE WHEN record_id = '' THEN 'inspection_id_required'
      WHEN NOT regexp_full_match(record_id, '[0-9]+') THEN 'inspection_id_format'
      WHEN number IS NULL THEN 'inspection_id_int64'
      WHEN number < 1 THEN 'inspection_id_minimum' END AS own_rule
  FROM checked
), clashes AS (
  SELECT batch_year, number FROM numbered WHERE own_rule IS NULL
  GROUP BY batch_year, number HAVING count(*) > 1
), identified AS (
  SELECT n.*, CASE WHEN own_rule IS NOT NULL THEN own_rule
      WHEN c.number IS NOT NULL THEN 'inspection_id_unique' END AS id_rule
  FROM numbered n LEFT JOIN clashes c ON n.batch_year = c.batch_year AND n.number = c.number
), gated AS (
  SELECT DISTINCT batch_year FROM identified WHERE id_rule IS NOT NULL
), copies AS (
  SELECT * FROM (
    SELECT *, min(number) OVER (PARTITION BY batch_year, {_COMPARED}) AS kept
    FROM checked WHERE batch_year NOT IN (SELECT batch_year FROM gated)
  ) WHERE number > kept
), issues AS ({" UNION ALL ".join([_ID_ISSUE, *_ROW_ISSUES, _DUPLICATE_ISSUE])}
), errors AS (
  SELECT DISTINCT batch_year, source_row_number FROM issues WHERE severity = 'error'
), accepted AS (
  SELECT * FROM checked ANTI JOIN errors USING (batch_year, source_row_number)
), summary AS (
  SELECT r.batch_year, r.raw_rows, a.n AS accepted_rows, r.raw_rows - a.n AS rejected_rows,
         i.e AS error_issues, i.w AS warning_issues,
         r.batch_year IN (SELECT batch_year FROM gated) AS duplicate_detection_skipped
  FROM (SELECT batch_year, count(*) AS raw_rows FROM checked GROUP BY 1) r
  JOIN (SELECT batch_year, count(*) AS n FROM accepted GROUP BY 1) a USING (batch_year)
  JOIN (SELECT batch_year, count(*) FILTER (severity = 'error') AS e,
               count(*) FILTER (severity = 'warning') AS w FROM issues GROUP BY 1) i
    USING (batch_year)
), curated AS (
  SELECT number AS record_id,
    trim(regexp_replace(name, ' +', ' ', 'g')) AS name,
    CASE WHEN license <> '' THEN nullif(cast(license AS bigint), 0) END AS license_number,
    nullif(risk, '') AS risk, nullif(upper(state), '') AS state, nullif(zip, '') AS zip_code,
    day AS event_date, result, lat AS latitude, lon AS longitude,
    batch_year AS inspection_year
  FROM accepted
), quarantined AS (
  SELECT {", ".join(f"c.{name}" for name in COLUMNS)},
    i.source_row_number AS dq_source_row_number, i.rule_id AS dq_rule_id,
    i."column" AS dq_column, i.value AS dq_value, i.message AS dq_message,
    i.severity AS dq_severity, d.kept AS dq_duplicate_of_inspection_id,
    i.batch_year AS dq_batch_year
  FROM issues i JOIN checked c USING (batch_year, source_row_number)
  LEFT JOIN copies d USING (batch_year, source_row_number)
  WHERE i.severity = 'error'
)"""


def _rules(*rule_ids: str) -> str:
    wanted = ", ".join(f"'{rule}'" for rule in rule_ids)
    return f"{_CHECKED} SELECT * FROM issues WHERE rule_id IN ({wanted})"


_PREFIXED = ", ".join(
    f"coalesce(concat(strlen({name}::varchar), ':', {name}), '-')"
    for name in ["source_row_number", *COLUMNS]
)
_ROW_HASH = f"('0x' || substr(md5(concat({_PREFIXED})), 1, 15))::BIGINT"


def _required(column: str, *others: str) -> str:
    """What else the chain finds, and the blanks, which the contract lets pass."""
    blank = _issue(
        "license_required" if column == "license" else f"{column}_required",
        column,
        f"{column} is required.",
        f"{column} = ''",
    )
    return f"{_rules(*others)} UNION ALL {blank}"


def _files(rows: str) -> str:
    return f"""
  SELECT batch_year, concat('orders/', batch_year) AS path, count(*) * 100 AS size_bytes,
         'md5-sum' AS checksum_algorithm,
         cast(cast(sum({_ROW_HASH}) AS decimal(38, 0)) AS varchar) AS checksum
  FROM {rows} GROUP BY batch_year"""


# What an earlier run saw, the outputs that are left of it, and whether both still agree.
_INCREMENTAL = f"""WITH {RAW_ORDERS_SQL}, files AS ({_files('raw_orders')}), earlier AS (
  SELECT * REPLACE (CASE WHEN batch_year = 1998 THEN upper(name) ELSE name END AS name)
  FROM raw_orders WHERE batch_year < 2001
), past AS ({_files('earlier')}), outputs AS (
  SELECT concat('curated/', batch_year) AS output, size_bytes FROM past WHERE batch_year <> 1999
  UNION ALL SELECT concat('quarantine/', batch_year), size_bytes + (batch_year = 2000)::INTEGER
  FROM past
), told AS (
  SELECT f.*, coalesce(p.checksum = f.checksum AND p.size_bytes = f.size_bytes
    AND c.size_bytes = p.size_bytes AND q.size_bytes = p.size_bytes, false) AS is_current
  FROM files f LEFT JOIN past p USING (batch_year)
  LEFT JOIN outputs c ON c.output = concat('curated/', f.batch_year)
  LEFT JOIN outputs q ON q.output = concat('quarantine/', f.batch_year)
)"""

_STATE = f"""
{_CHECKED}, files AS ({_files("raw_orders")}), state AS (
  SELECT cast(1 AS integer) AS schema_version, 'raw_orders' AS dataset, batch_year,
    '2024-01-01T00:00:00Z' AS completed_at_utc, path AS source_path,
    size_bytes AS source_size_bytes, upper(checksum_algorithm) AS checksum_algorithm,
    CASE WHEN batch_year >= {{changed}} THEN concat('x', checksum) ELSE checksum END AS checksum,
    raw_rows AS raw_row_count, accepted_rows AS accepted_row_count,
    rejected_rows AS rejected_record_count, error_issues AS quarantine_issue_count,
    error_issues AS error_count, warning_issues AS warning_count,
    concat('curated/', batch_year) AS curated_path, accepted_rows AS curated_row_count,
    accepted_rows * 10 AS curated_size_bytes, 'snappy' AS curated_compression,
    concat('quarantine/', batch_year) AS quarantine_path, error_issues AS quarantine_row_count,
    error_issues * 10 AS quarantine_size_bytes, 'snappy' AS quarantine_compression
  FROM files JOIN summary USING (batch_year)
)"""

_SPACES = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_STRIPPED = (
    f"regexp_replace(regexp_replace(padded, '^{_SPACES}+', ''), '{_SPACES}+$', '')"
)

_RUN_COLUMNS = """
  error_issues AS errors, warning_issues AS warnings,
  {gate} AS duplicate_detection_skipped, raw_rows AS raw, accepted_rows AS accepted,
  rejected_rows AS rejected, error_issues AS quarantine_issues, accepted_rows AS curated_rows,
  error_issues AS quarantine_rows"""
_CHANGED = _CHECKED.replace(
    "FROM raw_orders\n", "FROM raw_orders WHERE batch_year <> 1998 OR source_row_number % 10 <> 0\n", 1
)
_RUN_TWICE = f"""
SELECT 1 AS run, batch_year, 'processed' AS status, NULL::VARCHAR AS reason,
  {_RUN_COLUMNS.format(gate="duplicate_detection_skipped")}
FROM ({_CHECKED} SELECT * FROM summary)
UNION ALL
SELECT 2, batch_year, 'processed', NULL, {_RUN_COLUMNS.format(gate="duplicate_detection_skipped")}
FROM ({_CHANGED} SELECT * FROM summary) WHERE batch_year = 1998
UNION ALL
SELECT 2, batch_year, 'skipped', 'batch_state_current', {_RUN_COLUMNS.format(gate="NULL::BOOLEAN")}
FROM ({_CHECKED} SELECT * FROM summary) WHERE batch_year <> 1998"""

_REQUIRED = {
    "record_id": ("record_id = ''", "record_id <> '' AND try_cast(record_id AS bigint) IS NULL"),
    "name": ("trim(name) = ''", "false"),
    "license": ("false", "license <> '' AND try_cast(license AS bigint) IS NULL"),
    "event_date": ("event_date = ''", "event_date <> '' AND day IS NULL"),
    "result": ("result = ''", "false"),
    "latitude": ("false", "latitude <> '' AND lat IS NULL"),
    "longitude": ("false", "longitude <> '' AND lon IS NULL"),
}

ORACLES: dict[str, str] = {
    **FILE_ORACLES,
    "run_twice": _RUN_TWICE,
    "run_totals": f"""SELECT run, count(*) AS discovered, count(*) FILTER (status = 'processed') AS processed,
  count(*) FILTER (status = 'skipped') AS skipped FROM ({_RUN_TWICE}) GROUP BY run""",
    **{
        f"rule_id_{name}": _rules(f"inspection_id_{name}")
        for name in ("required", "format", "int64", "minimum", "unique")
    },
    "rule_date_required": _rules("inspection_date_required"),
    "rule_date_format": _rules("inspection_date_format"),
    "rule_year_matches_batch": _rules("inspection_year_matches_filename"),
    "rule_domain_required": _rules("inspection_result_required"),
    "rule_domain_allowed": _rules("inspection_result_allowed_values"),
    "rule_pair_consistency": _rules("coordinate_pair_consistency"),
    "rule_coord_numeric": _rules("latitude_numeric", "longitude_numeric"),
    "rule_coord_range": _rules("latitude_range", "longitude_range"),
    "rule_pattern_state": _rules("state_pattern"),
    "rule_pattern_zip": _rules("zip_pattern"),
    "rule_required_state": _required("state", "state_pattern"),
    "rule_required_zip": _required("zip", "zip_pattern"),
    "rule_required_license": _required("license", "license_digits", "license_zero_sentinel"),
    "rule_license": _rules("license_digits", "license_zero_sentinel"),
    "rule_risk": _rules("risk_missing", "risk_unknown"),
    "rule_domain_events": """
SELECT event_id, 'inspection_result_allowed_values' AS rule_id, 'event_type' AS "column",
       event_type AS value, 'Inspection result is not an allowed value.' AS message,
       'error' AS severity
FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')""",
    "rule_risk_segments": """
SELECT c_custkey, 'risk_unknown' AS rule_id, 'c_mktsegment' AS "column", c_mktsegment AS value,
       'c_mktsegment is not an allowed risk value.' AS message, 'warning' AS severity
FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
    "rule_pattern_pages": r"""
SELECT page_id, 'url_pattern' AS rule_id, 'url' AS "column", url AS value,
       'url does not match the required pattern.' AS message, 'error' AS severity
FROM pages WHERE NOT regexp_full_match(url, 'https?://[a-z.]+/(fr|de)/[0-9]+(\?.*)?')""",
    "key_clashes_lineitem": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "exact_duplicates": """
SELECT doc_id AS record_id, kept AS duplicate_of
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS kept FROM documents)
WHERE doc_id > kept""",
    "exact_duplicates_orders": """
SELECT cast(year(o_orderdate) AS smallint) AS batch_year, o_orderkey AS record_id,
       kept AS duplicate_of
FROM (SELECT *, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderdate) AS kept FROM orders)
WHERE o_orderkey > kept""",
    "exact_duplicate_issues": _rules("exact_duplicate_record"),
    "all_issues": f"{_CHECKED} SELECT * FROM issues",
    "issues_by_severity": f"""{_CHECKED}
SELECT batch_year, source_row_number,
       cast(count(*) FILTER (severity = 'error') AS integer) AS errors,
       cast(count(*) FILTER (severity = 'warning') AS integer) AS warnings,
       bool_or(severity = 'error') AS has_errors
FROM issues GROUP BY batch_year, source_row_number""",
    "duplicate_gate": f"""{_CHECKED}
SELECT DISTINCT batch_year,
       batch_year IN (SELECT batch_year FROM gated) AS duplicate_detection_skipped
FROM checked""",
    "accepted_rows": f"{_CHECKED} SELECT batch_year, source_row_number, record_id FROM accepted",
    "quarantine_rows": f"{_CHECKED} SELECT * FROM quarantined",
    "curated_projection": f"{_CHECKED} SELECT * FROM curated",
    "publish_curated_roundtrip": f"{_CHECKED} SELECT * FROM curated",
    "publish_quarantine_roundtrip": f"{_CHECKED} SELECT * FROM quarantined",
    "required_blank_counts": f"{_CHECKED}"
    + " UNION ALL ".join(
        f"""
SELECT batch_year, '{name}' AS source_column, count(*) FILTER ({blank}) AS blank_rows,
       count(*) FILTER ({invalid}) AS invalid_rows
FROM checked GROUP BY batch_year"""
        for name, (blank, invalid) in _REQUIRED.items()
    ),
    "batch_summary": f"{_CHECKED} SELECT * FROM summary",
    "reconciliation": f"""{_CHECKED}
SELECT batch_year, raw_rows, accepted_rows, rejected_rows, error_issues,
       c.n AS curated_rows, q.n AS quarantine_rows,
       accepted_rows + rejected_rows = raw_rows AS rows_add_up,
       c.n = accepted_rows AS curated_complete, q.n = error_issues AS quarantine_complete
FROM summary
JOIN (SELECT inspection_year AS batch_year, count(*) AS n FROM curated GROUP BY 1) c
  USING (batch_year)
JOIN (SELECT dq_batch_year AS batch_year, count(*) AS n FROM quarantined GROUP BY 1) q
  USING (batch_year)""",
    "issue_metrics": f"""{_CHECKED}
SELECT batch_year, rule_id, "column", severity, count(*) AS issue_count
FROM issues GROUP BY ALL""",
    "run_issue_metrics": f"""{_CHECKED}
SELECT batch_year, rule_id, "column", severity, count(*) AS issue_count
FROM issues GROUP BY ALL""",
    "schema_conformance": """
SELECT event_type, conforms, missing, unexpected, count(*) AS row_count FROM (
  SELECT event_type,
    CASE event_type WHEN 'signup' THEN list_concat(json_keys(props), ['K'])
      WHEN 'view' THEN list_concat(['event'], json_keys(props))
      ELSE list_concat(json_keys(props), ['event']) END AS header,
    header = ['k', 'event'] AS conforms,
    array_to_string(list_filter(['k', 'event'], lambda n: NOT list_contains(header, n)), ',')
      AS missing,
    array_to_string(list_filter(header, lambda n: NOT list_contains(['k', 'event'], n)), ',')
      AS unexpected
  FROM events)
GROUP BY event_type, conforms, missing, unexpected""",
    "batch_row_counts": f"""
WITH {RAW_ORDERS_SQL}, listed AS (
  SELECT batch_year FROM raw_orders
  UNION SELECT cast(batch_year + 1 AS smallint) FROM raw_orders
)
SELECT l.batch_year, count(r.batch_year) AS row_count, count(r.batch_year) > 0 AS has_rows
FROM listed l LEFT JOIN raw_orders r ON l.batch_year = r.batch_year GROUP BY l.batch_year""",
    "batch_year_range": r"""
WITH names AS (
  SELECT concat('food_inspections_',
    CASE WHEN o_orderkey % 17 = 0 THEN substr(cast(year(o_orderdate) AS varchar), 1, 3)
         ELSE cast(year(o_orderdate) AS varchar) END,
    CASE WHEN o_orderkey % 19 = 0 THEN '.CSV' ELSE '.csv' END) AS file_name
  FROM orders
), years AS (
  SELECT file_name, try_cast(nullif(
    regexp_extract(file_name, '^food_inspections_([0-9]{4})\.csv$', 1), '') AS smallint)
    AS batch_year
  FROM names
)
SELECT file_name, batch_year, coalesce(batch_year BETWEEN 1996 AND 2000, false) AS accepted,
       count(*) AS row_count
FROM years GROUP BY ALL""",
    "batch_fingerprint": f"""
WITH {RAW_ORDERS_SQL}
SELECT batch_year, count(*) AS row_count,
       cast(cast(sum({_ROW_HASH}) AS decimal(38, 0)) AS varchar) AS checksum
FROM raw_orders GROUP BY batch_year""",
    "partition_guard": f"""
WITH {RAW_ORDERS_SQL}, parts AS (
  SELECT batch_year, nullif(substr(event_date, 1, 4), '') AS part,
         try_cast(nullif(substr(event_date, 1, 4), '') AS double) AS number
  FROM raw_orders
)
SELECT batch_year, count(*) AS row_count, count(*) FILTER (part IS NULL) AS null_partitions,
       count(*) FILTER (part IS NOT NULL AND (number IS NULL OR number % 1 <> 0)) AS not_integral,
       count(*) FILTER (number % 1 = 0 AND number <> batch_year) AS other_batch
FROM parts GROUP BY batch_year""",
    "severity_guard": f"""{_CHECKED}
SELECT batch_year, count(*) AS row_count,
       count(*) FILTER (rule_id = 'risk_missing') AS null_severities,
       count(*) FILTER (rule_id <> 'risk_missing' AND severity <> 'error') AS other_severities
FROM issues GROUP BY batch_year""",
    "source_row_numbers": f"""
WITH {RAW_ORDERS_SQL}
SELECT batch_year, source_row_number AS seq, record_id,
       row_number() OVER (PARTITION BY batch_year ORDER BY source_row_number) + 1
         AS source_row_number
FROM raw_orders""",
    "incremental_pending": f"""{_INCREMENTAL}
SELECT batch_year, path, size_bytes, checksum_algorithm, checksum FROM told WHERE NOT is_current""",
    "incremental_skipped": f"""{_INCREMENTAL}
SELECT batch_year, path, size_bytes, checksum_algorithm, checksum FROM told WHERE is_current""",
    "multi_batch_summary": f"""{_INCREMENTAL}
SELECT count(*) AS discovered, count(*) FILTER (NOT is_current) AS processed,
       count(*) FILTER (is_current) AS skipped
FROM told""",
    "batch_state": f"{_STATE.replace("{changed}", "2000")} SELECT * FROM state",
    "run_report": f"""{_STATE.replace("{changed}", "9999")}
SELECT batch_year, CASE WHEN batch_year >= 1998 THEN 'processed' ELSE 'skipped' END AS status,
  CASE WHEN batch_year < 1998 THEN 'batch_state_current' END AS reason, path, size_bytes,
  f.checksum_algorithm, f.checksum, completed_at_utc, error_count AS errors,
  warning_count AS warnings,
  CASE WHEN batch_year >= 1998 THEN duplicate_detection_skipped END AS duplicate_detection_skipped,
  raw_row_count AS raw, accepted_row_count AS accepted, rejected_record_count AS rejected,
  quarantine_issue_count AS quarantine_issues, curated_path, curated_row_count AS curated_rows,
  curated_size_bytes, curated_compression, quarantine_path,
  quarantine_row_count AS quarantine_rows, quarantine_size_bytes, quarantine_compression
FROM state JOIN files f USING (batch_year) JOIN summary USING (batch_year)""",
    "scalar_cleaning": f"""
WITH texts AS (
  SELECT doc_id, source, concat(' ', chr(9), chr(160), ' ', chr(28), text, chr(8195), chr(10), ' ')
    AS padded
  FROM documents
)
SELECT doc_id, md5({_STRIPPED}) AS stripped,
       md5(regexp_replace(padded, '[\\t\\n\\f\\r ]+', ' ', 'g')) AS collapsed,
       md5(regexp_replace({_STRIPPED}, '[\\t\\n\\f\\r ]+', ' ', 'g')) AS cleaned,
       upper(source) AS source_upper, regexp_full_match(padded, '{_SPACES}*') AS blank
FROM texts""",
    "scalar_casts": """
SELECT l_orderkey, cast(l_linenumber AS bigint) AS line_number,
  CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END AS part_key,
  nullif(l_suppkey % 4, 0) AS sentinel,
  CASE WHEN l_suppkey % 5 <> 0 THEN l_discount END AS discount,
  cast(l_shipdate AS date) AS ship_date,
  CASE WHEN l_suppkey % 3 <> 0 THEN cast(year(l_shipdate) AS integer) END AS iso_year
FROM lineitem""",
}
