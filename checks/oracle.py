"""The queries again as SQL over the given tables."""

from __future__ import annotations

RAW = """
raw AS (
    SELECT event_id, ts, user_id,
           CAST(event_id AS VARCHAR) AS receipt_no,
           CAST(user_id AS VARCHAR) AS shop_num,
           CASE WHEN event_id % 10 = 0 THEN 'bad-' || event_id
                WHEN event_id % 17 = 0 THEN NULL
                ELSE strftime(ts, '%d.%m.%Y %H:%M:%S') END AS dttm_raw,
           event_type,
           CAST(ts AS DATE) AS dt,
           'delivery_' || strftime(ts, '%Y%m%d') || '.csv' AS file_name
    FROM events
)"""

MAPPING = """
mapping AS (
    SELECT CAST(c_custkey AS VARCHAR) AS code, c_custkey + 1000 AS object_id
    FROM customer
    JOIN region ON r_regionkey = c_custkey % 5
    JOIN nation ON n_nationkey = c_nationkey
    WHERE r_name = 'ASIA'
)"""

STAGED = f"""
{RAW}, {MAPPING},
staged AS (
    SELECT raw.*, mapping.object_id AS shop_id,
           row_number() OVER (PARTITION BY dt, file_name ORDER BY receipt_no) AS row_index,
           TRY_STRPTIME(dttm_raw, '%d.%m.%Y %H:%M:%S') AS dttm,
           CASE WHEN dttm_raw IS NULL THEN 'TypeError'
                WHEN dttm_raw LIKE 'bad-%' THEN 'ValueError' END AS error_class,
           CASE WHEN dttm_raw IS NULL THEN 'strptime() argument 1 must be str, not None'
                WHEN dttm_raw LIKE 'bad-%' THEN 'time data ''' || dttm_raw
                    || ''' does not match format ''%d.%m.%Y %H:%M:%S''' END AS error_value
    FROM raw LEFT JOIN mapping ON shop_num = code
)"""

FIXED = """
fixed AS (
    SELECT raw.*,
           TRY_STRPTIME(dttm_raw, '%d.%m.%Y %H:%M:%S') AS parsed,
           abs(date_diff('day', CAST(parsed AS DATE), DATE '2024-01-15')) > 7 AS far,
           CASE WHEN dttm_raw IS NULL OR far THEN 'TypeError'
                WHEN parsed IS NULL THEN 'ValueError' END AS error_class,
           CASE WHEN dttm_raw IS NULL THEN 'strptime() argument 1 must be str, not None'
                WHEN parsed IS NULL THEN 'time data ''' || dttm_raw
                    || ''' does not match format ''%d.%m.%Y %H:%M:%S'''
                WHEN far THEN 'Range between 2024-01-15 and ' || strftime(parsed, '%Y-%m-%d %H:%M:%S')
                    || ' is greater than 1 week' END AS error_value,
           CASE WHEN NOT far THEN TIMESTAMP '2024-01-15 00:00:00'
                + to_hours(least(hour(parsed), 20)) + to_minutes(minute(parsed))
                + to_seconds(second(parsed)) END AS fixed_dttm
    FROM raw
)"""

AS_OF = "TIMESTAMP '2024-02-01 12:30:15'"
AS_OF_DAY = "TIMESTAMP '2024-02-01 00:00:00'"


def info(code: str) -> str:
    """JSON of a raw row; null fields are left out."""
    return f"""
        '{{"receipt_no":"' || receipt_no || '","shop_num":"' || shop_num || '"'
        || coalesce(',"dttm_raw":"' || dttm_raw || '"', '')
        || ',"event_type":"' || event_type || '","receipt_code":"' || {code} || '"}}'"""


CODE = "receipt_no || event_type"


def receipts(source: str, dttm: str, dt: str, where: str, added: str = AS_OF, shop: str = "shop_id") -> str:
    return f"""
        SELECT {CODE} AS code, {dttm} AS dttm, {added} AS dttm_added, {added} AS dttm_modified,
               0 AS version, {shop} AS shop_id, {dt} AS dt, 'delivery' AS data_type, {info(CODE)} AS info
        FROM {source} WHERE {where}"""


IS_VALID = "shop_id IS NOT NULL AND dttm IS NOT NULL"
VALID = f"WITH {STAGED} " + receipts("staged", "dttm", "dt", IS_VALID)
# The declared table holds shop ids as 32-bit numbers.
DECLARED_SHOP = "CAST(shop_id AS INTEGER)"
IMPORTED = f"WITH {STAGED} " + receipts("staged", "dttm", "dt", IS_VALID, shop=DECLARED_SHOP)

ERRORS = """
    SELECT 'can''t map shop_id for shop_num=''' || coalesce(shop_num, 'None') || '''' AS Error
    FROM staged WHERE shop_id IS NULL
    UNION ALL
    SELECT error_class || ': ' || error_value || ': ' || file_name || ': row: ' || row_index
    FROM staged WHERE dttm IS NULL"""

ROW_INDEX = f"""
    WITH {RAW}
    SELECT receipt_no, file_name,
           row_number() OVER (PARTITION BY dt, file_name ORDER BY receipt_no NULLS FIRST) AS row_index
    FROM raw"""

STAGE_MAPPED = f"""
    WITH {RAW}, {MAPPING}
    SELECT receipt_no, shop_num, object_id AS shop_id FROM raw LEFT JOIN mapping ON shop_num = code"""

DAYS = """
days AS (
    SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY))
                AS DATE) AS dt
)"""

DAY_FOLDER = "'day=' || strftime(ts, '%Y%m%d')"

# In the job the raw files are the day folders, whose names the error texts show.
HISTORY = f"""
    WITH {STAGED}
    SELECT 'transformed' AS output,
           {CODE} || '|' || strftime(dttm, '%Y-%m-%d %H:%M:%S') || '|' || shop_id || '|'
           || strftime(dt, '%Y-%m-%d') || '|delivery|' || {info(CODE)} AS content
    FROM staged WHERE shop_id IS NOT NULL AND dttm IS NOT NULL
    UNION ALL
    SELECT 'errors', Error FROM (
        SELECT * FROM ({ERRORS.replace("|| file_name ||", f"|| {DAY_FOLDER} ||")})
    ) AS found
    UNION ALL
    SELECT 'shop_ids', CAST(shop_id AS VARCHAR) FROM staged WHERE shop_id IS NOT NULL"""



def murmur3(text: str, seed: str) -> str:
    """The public MurmurHash3 (32 bits) of an ASCII text, in Spark's form: the bytes after the last
    whole word are mixed in one by one, and a null leaves the seed as it is."""

    def times(value: str, factor: int) -> str:
        return f"(({value}) * {factor}::UBIGINT % 4294967296)"

    def rotated(value: str, bits: int) -> str:
        return f"((({value}) * {1 << bits} % 4294967296) + (({value}) // {1 << (32 - bits)}))"

    def byte(position: str) -> str:
        return f"unicode(substr({text}, {position}, 1))::UBIGINT"

    words = " + ".join(f"{byte(f'4 * i + {n + 1}')} * {256 ** n}" for n in range(4))
    pieces = (
        f"list_transform(range(0, length({text}) // 4), lambda i: {words})"
        f" || list_transform(range(length({text}) // 4 * 4, length({text})), lambda i: {byte('i + 1')})")
    mixed = f"list_transform({pieces}, lambda k: {times(rotated(times('k', 0xCC9E2D51), 15), 0x1B873593)})"
    step = f"({times(rotated('xor(h, k)', 13), 5)} + {0xE6546B64}) % 4294967296"
    state = f"list_reduce(list_prepend(({seed})::UBIGINT, {mixed}), lambda h, k: {step})"
    state = f"xor({state}, length({text})::UBIGINT)"
    for factor, shift in ((0x85EBCA6B, 16), (0xC2B2AE35, 13), (1, 16)):
        # each round is a list of one, so that its value is worked out once
        state = f"list_transform([{state}], lambda h: {times(f'xor(h, h // {1 << shift})', factor)})[1]"
    return f"CASE WHEN {text} IS NULL THEN ({seed})::UBIGINT ELSE {state} END"


def tie_key(*columns: str) -> str:
    """What parts rows of equal first column: a hash that marks nulls and lengths in bytes."""
    values = [f"coalesce(octet_length(encode({name})) || ':' || {name}, '-')" for name in columns]
    return f"md5({' || '.join(values)})"


ERRORS_TIES = f"""
    WITH {STAGED},
    tied AS (
        SELECT * EXCLUDE (row_index), row_number() OVER (
            PARTITION BY dt, file_name
            ORDER BY event_type NULLS FIRST, {tie_key("receipt_no", "shop_num", "dttm_raw")}) AS row_index
        FROM staged)
    {ERRORS.replace("FROM staged", "FROM tied")}"""

FAN_OUT = f"""
    WITH {STAGED},
    twice AS (
        SELECT staged.* EXCLUDE (shop_id), shop_id + extra AS shop_id
        FROM staged, (SELECT unnest([0, 5000]) AS extra) WHERE shop_id IS NOT NULL OR extra = 0),
    found AS (
        SELECT 'valid' AS output, {CODE} || '|' || shop_id AS content
        FROM twice WHERE shop_id IS NOT NULL AND dttm IS NOT NULL
        UNION ALL SELECT 'errors', Error FROM ({ERRORS.replace("FROM staged", "FROM twice")}) AS e
        UNION ALL
        SELECT 'counts', strftime(dt, '%Y-%m-%d') || '|' || count(DISTINCT receipt_no) || '|'
            || (count(*) FILTER (shop_id IS NULL) + count(*) FILTER (dttm IS NULL)) || '|'
            || count(*) FILTER (shop_id IS NOT NULL AND dttm IS NOT NULL) || '|'
            || count(*) FILTER (shop_id IS NOT NULL)
        FROM twice GROUP BY dt)
    SELECT output, content FROM found"""



def reparsed(fmt: str, moved: str = "") -> str:
    """Times and errors when the same times are shown by another format."""
    return f"""
        WITH {STAGED}
        SELECT receipt_no, dttm {moved} AS dttm, error_class,
               replace(error_value, '%d.%m.%Y %H:%M:%S', '{fmt}') AS error_value FROM staged"""


ADJACENT_SHOP = """CASE event_type WHEN 'error' THEN 'x' WHEN 'click' THEN '1' WHEN 'view' THEN '11' ELSE '2' END"""


ORACLE = {
    "rows_per_planned_file": f"""
        WITH {RAW}, {DAYS}
        SELECT days.dt, 'delivery_' || strftime(days.dt, '%Y%m%d') || '.csv' AS file_name,
               'ASIA_delivery_' || strftime(days.dt, '%Y%m%d') || '_transformed.parquet' AS output_name,
               count(raw.event_id) AS raw_rows
        FROM days LEFT JOIN raw ON raw.dt = days.dt GROUP BY days.dt""",
    "rows_per_shop_file": f"""
        WITH {RAW}, {MAPPING}, {DAYS},
        plan AS (SELECT dt, code FROM days, (SELECT DISTINCT code FROM mapping) AS codes),
        found AS (SELECT dt, shop_num, count(*) AS n FROM raw GROUP BY dt, shop_num)
        SELECT plan.dt, code AS shop_code,
               printf('delivery_%s_%d-%d-%d.csv', code, year(plan.dt), month(plan.dt), day(plan.dt)) AS file_name,
               coalesce(n, 0) AS raw_rows
        FROM plan LEFT JOIN found ON found.dt = plan.dt AND shop_num = code""",
    "csv_day_scan": f"""
        WITH {RAW}
        SELECT receipt_no, shop_num, dttm_raw, event_type, dt, {DAY_FOLDER} AS file_name FROM raw""",
    "csv_shop_scan": f"""
        WITH {RAW}
        SELECT receipt_no, shop_num, dttm_raw, event_type, dt,
               {DAY_FOLDER} || '/shop=' || event_type AS file_name
        FROM raw WHERE event_type <> 'error'""",
    "csv_shop_scan_adjacent": f"""
        WITH {RAW}, {DAYS},
        named AS (SELECT *, 'name=' || {ADJACENT_SHOP} || day(dt) AS name FROM raw),
        plan AS (SELECT DISTINCT days.dt AS planned, 'name=' || shop || day(days.dt) AS name
                 FROM days, (SELECT DISTINCT {ADJACENT_SHOP} AS shop FROM raw) AS shops WHERE shop <> 'x')
        SELECT receipt_no, shop_num, dttm_raw, event_type, planned AS dt, named.name AS file_name
        FROM named JOIN plan ON plan.name = named.name""",
    "csv_options_scan": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "positional_rename": f"WITH {RAW} SELECT receipt_no, shop_num, dttm_raw, event_type FROM raw",
    "jdbc_scan_partitioned": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "shop_mapping": f"WITH {MAPPING} SELECT code, object_id FROM mapping",
    "stage_mapped": STAGE_MAPPED,
    "stage_mapped_shuffled": STAGE_MAPPED,
    "stage_mapped_fan_out": FAN_OUT,
    "stage_mapped_numeric_code": f"""
        WITH {RAW}, {MAPPING},
        marked AS (SELECT receipt_no, shop_num || CASE event_type WHEN 'error' THEN 'x' ELSE '' END AS shop_num FROM raw)
        SELECT receipt_no, shop_num, object_id AS shop_id FROM marked LEFT JOIN mapping ON shop_num = code""",
    "receipt_code_concat": f"""
        WITH {RAW}
        SELECT receipt_no, concat_ws('', receipt_no, dttm_raw) AS receipt_code FROM raw""",
    "receipt_code_hash": f"""
        WITH {RAW},
        one AS (SELECT *, {murmur3("receipt_no", "42")} AS h1 FROM raw),
        two AS (SELECT *, {murmur3("shop_num", "h1")} AS h2 FROM one),
        three AS (SELECT *, {murmur3("dttm_raw", "h2")} AS h3 FROM two),
        four AS (SELECT *, {murmur3("event_type", "h3")} AS h4 FROM three)
        SELECT receipt_no,
               CAST(CASE WHEN h4 >= 2147483648 THEN h4::BIGINT - 4294967296 ELSE h4::BIGINT END AS INTEGER)
                   AS receipt_code
        FROM four""",
    "receipt_code_collisions": f"""
        WITH {RAW}
        SELECT shop_num || event_type AS code, count(*) AS rows FROM raw
        GROUP BY shop_num || event_type
        HAVING count(DISTINCT concat_ws('|', receipt_no, shop_num, coalesce(dttm_raw, '-'), event_type)) > 1""",
    "parse_dttm": f"WITH {STAGED} SELECT receipt_no, dttm FROM staged",
    "parse_fix_date": f"""
        WITH {RAW}, {FIXED}
        SELECT receipt_no, fixed_dttm AS dttm, error_class, error_value FROM fixed""",
    "parse_errors": f"WITH {STAGED} SELECT receipt_no, error_class, error_value FROM staged",
    "parse_weekday": reparsed("%A %d %b %Y %H:%M:%S"),
    "parse_12_hour": reparsed("%d.%m.%Y %I:%M:%S %p"),
    "parse_offset": reparsed("%Y %j %H:%M:%S%z", "- INTERVAL '150 minutes'"),
    "parse_iso_week": reparsed("%G-W%V-%u %H:%M:%S"),
    "parse_week_of_year": reparsed("%Y %U %w %H:%M:%S"),
    "row_index_per_file": ROW_INDEX,
    "row_index_split_files": ROW_INDEX,
    "info_json": f"WITH {RAW} SELECT receipt_no, {info('receipt_no')} AS info FROM raw",
    "receipts_valid": VALID,
    "receipts_valid_fixed_date": f"""
        WITH {RAW}, {MAPPING}, {FIXED},
        mapped AS (SELECT fixed.*, object_id AS shop_id FROM fixed JOIN mapping ON shop_num = code)
        """ + receipts("mapped", "fixed_dttm", "DATE '2024-01-15'", "fixed_dttm IS NOT NULL"),
    "receipts_errors": f"WITH {STAGED} {ERRORS}",
    "receipts_errors_fixed_date": f"""
        WITH {RAW}, {MAPPING}, {FIXED},
        staged AS (
            SELECT fixed.*, object_id AS shop_id, fixed_dttm AS dttm,
                   row_number() OVER (PARTITION BY file_name ORDER BY receipt_no) AS row_index
            FROM fixed LEFT JOIN mapping ON shop_num = code
        ) {ERRORS}""",
    "receipts_errors_ranked": f"WITH {STAGED} {ERRORS}",
    "receipts_errors_ties": ERRORS_TIES,
    "receipts_errors_ties_ranked": ERRORS_TIES,
    "receipts_errors_ties_split": ERRORS_TIES,
    "shop_ids": f"WITH {STAGED} SELECT shop_id FROM staged WHERE shop_id IS NOT NULL",
    "stage_counts": f"""
        WITH {STAGED}
        SELECT dt, count(*) AS raw_rows,
               count(*) FILTER (shop_id IS NULL) + count(*) FILTER (dttm IS NULL) AS error_rows,
               count(*) FILTER (shop_id IS NOT NULL AND dttm IS NOT NULL) AS valid_rows,
               count(*) FILTER (shop_id IS NOT NULL) AS mapped_rows
        FROM staged GROUP BY dt""",
    "conform_receipt": f"WITH {STAGED} " + receipts(
        "staged", "dttm", "dt", IS_VALID, added=AS_OF_DAY, shop=DECLARED_SHOP),
    "parquet_overwrite_roundtrip":
        "SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders",
    "history_overwrite_day": f"""
        WITH {STAGED}
        SELECT {CODE} AS code, shop_id, CASE WHEN dt <= DATE '2024-01-15' THEN 1 ELSE 0 END AS version, dt
        FROM staged WHERE shop_id IS NOT NULL AND dttm IS NOT NULL AND dt <> DATE '2024-01-03'""",
    "jdbc_append_roundtrip": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
    "jdbc_append_skip": IMPORTED,
    "import_receipts": IMPORTED,
    "forecast_records": """
        SELECT event_id, ts AS dttm, CAST(user_id AS INTEGER) AS shop_id, event_type
        FROM events ORDER BY event_id LIMIT 10""",
    "forecast_records_rejects": """
        WITH given AS (
            SELECT event_id, ts, event_id % 15 = 0 AS bad_time,
                   CASE WHEN event_id % 10 = 0 THEN 'x' || user_id WHEN event_id % 17 = 0 THEN '99999999999'
                        WHEN event_id % 19 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS shop,
                   CASE WHEN event_id % 10 = 0 THEN 'not a value of type int'
                        WHEN event_id % 17 = 0 THEN 'out of range for type int' END AS bad_shop
            FROM events)
        SELECT event_id, 'loaded' AS output, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '|' || coalesce(shop, 'none') AS content
        FROM given WHERE NOT bad_time AND bad_shop IS NULL
        UNION ALL
        SELECT event_id, 'rejected', 'shop_id|' || shop || '|' || bad_shop FROM given WHERE bad_shop IS NOT NULL
        UNION ALL
        SELECT event_id, 'rejected', 'dttm|never-' || event_id || '|not a value of type timestamp' FROM given WHERE bad_time""",
    "forecast_records_import": f"""
        SELECT CAST(event_id AS VARCHAR) AS code, ts AS dttm, {AS_OF_DAY} AS dttm_added,
               {AS_OF_DAY} AS dttm_modified, 0 AS version, CAST(user_id AS INTEGER) AS shop_id, CAST(ts AS DATE) AS dt,
               CAST(NULL AS VARCHAR) AS data_type, CAST(NULL AS VARCHAR) AS info
        FROM events""",
    "preview_table": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3""",
    "history_extract": HISTORY,
    "history_extract_daily": HISTORY,
    "history_extract_comma": HISTORY,
    "history_extract_no_valid": f"""
        WITH {STAGED.replace("LEFT JOIN mapping ON shop_num = code", "LEFT JOIN mapping ON false")}
        {ERRORS.replace("|| file_name ||", f"|| {DAY_FOLDER} ||")}""",
}
