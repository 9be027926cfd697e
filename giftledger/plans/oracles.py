"""The registered queries as SQL for another engine, over the same tables. Used only to check results.

Written from the meaning of each query, not from its Spark plan: identity, for one, asks for each record which ZIPs
are on offer.
"""

from __future__ import annotations

from ..functions.text import STREET_WORDS
from ..schemas import SOURCE_COLUMNS
from ..sources.testdata import records_cte

DAY_1, DAY_3, RESEND_DAY = "DATE '2025-01-01'", "DATE '2025-01-03'", "DATE '2025-01-04'"
AS_OF = "DATE '2001-08-02'"


def _words(text: str) -> str:
    """The words of a text, in order, as a list."""
    return rf"regexp_extract_all({text}, '\S+')"


def _name(text: str) -> str:
    allowed = "list_filter(string_split(translate(lower({0}), '-_', '  '), ''), lambda c: c SIMILAR TO '[a-z0-9\\s]')".format(text)
    return f"array_to_string({_words(f"array_to_string({allowed}, '')")}, ' ')"


def _address(text: str) -> str:
    """Word by word: a street word is looked up, any other stays."""
    pairs = ", ".join(f"'{word}': '{short}'" for word, short in STREET_WORDS.items())
    cleaned = rf"regexp_replace(lower({text}), '[^\w\s]', '', 'g')"
    return f"array_to_string(list_transform({_words(cleaned)}, lambda w: coalesce(map_extract_value(MAP {{{pairs}}}, w), w)), ' ')"


def _zip(text: str) -> str:
    digits = f"regexp_replace(coalesce({text}, ''), '[^0-9]', '', 'g')"
    return f"CASE WHEN {digits} = '' THEN '' ELSE lpad(substr({digits}, 1, 5), 5, '0') END"


def _date(text: str) -> str:
    return f"CASE WHEN length({text}) = 8 THEN CAST(try_strptime({text}, '%m%d%Y') AS DATE) END"


CITY_STATE = "coalesce(CITY, '') || ' ' || coalesce(STATE, '')"


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100 / {whole}, 2)"


def _staged_from(source: str) -> str:
    return f"""
    SELECT SUB_ID AS sub_id, CMTE_ID AS cmte_id, TRAN_ID AS tran_id, NAME AS name_raw, CITY AS city_raw,
      STATE AS state, ZIP_CODE AS zip_raw, {_name("NAME")} AS donor_name_normalized,
      {_address(CITY_STATE)} AS donor_address_normalized, {_zip("ZIP_CODE")} AS zip_normalized,
      CAST(TRANSACTION_AMT AS DECIMAL(18,2)) AS contribution_amount, {_date("TRANSACTION_DT")} AS contribution_date,
      ENTITY_TP AS entity_type, _load_date AS load_date
    FROM {source} WHERE ENTITY_TP = 'IND'"""


AMENDED = f"""
    SELECT * REPLACE (CAST(TRANSACTION_AMT + 100 AS DECIMAL(18,2)) AS TRANSACTION_AMT, {RESEND_DAY} AS _load_date)
    FROM raw WHERE AMNDT_IND = 'A'"""


def _identity(staged: str, scope: str = "date", route: bool = False, zero_is_null: bool = False) -> dict[str, str]:
    """CTEs ending in ``dim``, for the staged rows in ``staged``.

    A record's ZIP counts unless it is blank. One without gets the candidate ZIPs of its own name and address by a subquery;
    its key is the smallest candidate's, or what it has itself.
    """
    unusable = ("", "00000") if zero_is_null else ("",)
    usable = " AND ".join(f"zip_normalized <> '{z}'" for z in unusable)
    same = "c.donor_name_normalized = r.donor_name_normalized AND c.donor_address_normalized = r.donor_address_normalized"
    if scope == "date":
        same += " AND c.load_date = r.load_date"
    candidates = f"FROM {staged} c WHERE {usable.replace('zip_normalized', 'c.zip_normalized')} AND c.donor_address_normalized <> '' AND {same}"
    chosen = "CASE WHEN identity_conflict THEN NULL ELSE coalesce(own_zip, first_zip) END"
    return {
        "known": f"SELECT *, CASE WHEN {usable} THEN zip_normalized END AS own_zip FROM {staged}",
        "offered": f"""
            SELECT *, CASE WHEN own_zip IS NULL THEN (SELECT min(c.zip_normalized) {candidates}) END AS first_zip,
              CASE WHEN own_zip IS NULL THEN (SELECT max(c.zip_normalized) {candidates}) END AS last_zip
            FROM known r""",
        "judged": f"SELECT *, {"coalesce(first_zip < last_zip, FALSE)" if route else "FALSE"} AS identity_conflict FROM offered",
        "keyed": f"""
            SELECT *, donor_name_normalized || coalesce('|zip:' || {chosen},
                CASE WHEN donor_address_normalized = '' OR identity_conflict THEN '|id:' || sub_id ELSE '|addr:' || donor_address_normalized END) AS canonical_key,
              CASE WHEN own_zip IS NOT NULL THEN 'rule1' WHEN first_zip IS NULL AND donor_address_normalized = '' THEN 'no_match' ELSE 'rule2' END AS match_rule
            FROM judged""",
        "dim": """
            SELECT md5(canonical_key) AS donor_id, sub_id, donor_name_normalized, donor_address_normalized,
              zip_normalized, match_rule, identity_conflict, load_date FROM keyed""",
    }


def _with(select: str, **ctes: str) -> str:
    body = ",\n".join(f"{name} AS ({text})" for name, text in {"raw": records_cte(), **ctes}.items())
    return f"WITH {body}\n{select}"


STAGED = {"staged": _staged_from("raw")}


def _over_identity(select: str, **choices) -> str:
    return _with(select, **STAGED, **_identity("staged", **choices))


def _over_mart(select: str) -> str:
    summary = """
        SELECT donor_id, count(*) AS contribution_count,
          CAST(sum(contribution_amount) AS DECIMAL(18,2)) AS total_amount,
          min(contribution_date) AS first_contribution_date, max(contribution_date) AS last_contribution_date
        FROM staged JOIN dim USING (sub_id) GROUP BY donor_id"""
    scored = f"""
        SELECT *, CAST({AS_OF} - last_contribution_date AS INTEGER) AS days_since_last FROM summary"""
    buckets = """
        SELECT *,
          CASE WHEN days_since_last <= 90 THEN 5 WHEN days_since_last <= 180 THEN 4 WHEN days_since_last <= 365 THEN 3
               WHEN days_since_last <= 730 THEN 2 ELSE 1 END AS recency_score,
          CASE WHEN contribution_count <= 1 THEN 1 WHEN contribution_count <= 2 THEN 2
               WHEN contribution_count <= 5 THEN 3 WHEN contribution_count <= 10 THEN 4 ELSE 5 END AS frequency_score,
          CASE WHEN total_amount IS NULL OR total_amount < 100 THEN 1 WHEN total_amount < 500 THEN 2
               WHEN total_amount < 1000 THEN 3 WHEN total_amount < 5000 THEN 4 ELSE 5 END AS monetary_score
        FROM dated"""
    mart = """
        SELECT *, CAST(0.4 * recency_score + 0.3 * frequency_score + 0.3 * monetary_score AS DECIMAL(4,2))
          AS engagement_score FROM bucketed"""
    return _with(
        select,
        **STAGED,
        **_identity("staged", scope="all"),
        summary=summary,
        dated=scored,
        bucketed=buckets,
        mart=mart,
    )


def _is_blank(column: str) -> str:
    return f"trim(coalesce(CAST({column} AS STRING), '')) = ''"


def _null_counts(good: str = "TRUE", total: str = "(SELECT count(*) FROM raw)") -> str:
    """One row per column; ``good`` tells which rows count towards the blanks."""
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER ({good} AND {_is_blank(c)}) AS null_count, "
        f"{_pct(f'count(*) FILTER ({good} AND {_is_blank(c)})', total)} AS null_pct FROM raw"
        for i, c in enumerate(SOURCE_COLUMNS)
    )


def _key_population(column: str) -> str:
    return _with(
        f"""
        SELECT populated, total, {_pct("populated", "total")} AS pct,
          CASE WHEN populated * 100.0 / total > 95 THEN 'reliable' WHEN populated * 100.0 / total > 50 THEN 'preferred'
               ELSE 'fallback' END AS verdict
        FROM (SELECT count(*) FILTER (NOT {_is_blank(column)}) AS populated, count(*) AS total FROM raw)"""
    )


GIFTS = """
    SELECT trim(NAME) AS NAME, trim(TRANSACTION_DT) AS TRANSACTION_DT, CAST(TRANSACTION_AMT AS STRING) AS TRANSACTION_AMT,
      count(*) AS n FROM raw GROUP BY 1, 2, 3"""

TEXT_COLUMNS = ", ".join(
    c if c == "TRANSACTION_AMT" else f"coalesce({c}, '') AS {c}" for c in SOURCE_COLUMNS
)


def _upserted(target: str, source: str, columns: str = "*") -> str:
    return f"""
    SELECT {columns} FROM {target} WHERE sub_id NOT IN (SELECT sub_id FROM {source})
    UNION ALL SELECT {columns} FROM {source}"""


def _prefixed(text: str) -> str:
    """The identity CTEs under other names, for a second use in one statement."""
    for name in ("known", "offered", "judged", "keyed"):
        text = text.replace(f"FROM {name}", f"FROM first_{name}")
    return text


RESENT = {"amended": AMENDED, "resent": _staged_from("amended")}

FALLBACK = "donor_name_normalized, contribution_date, contribution_amount, sub_id, load_date"

PER_DAY = "SELECT _load_date AS load_date, count(*) AS row_count FROM raw GROUP BY 1"


def _quality() -> str:
    def check(name: str, metric: str, passed: str, source: str) -> str:
        return (
            f"SELECT '{name}' AS check_name, CAST({metric} AS DOUBLE) AS metric, {passed} AS passed FROM {source}"
        )

    def violations(name: str, where: str, source: str) -> str:
        n = f"count(*) FILTER ({where})"
        return check(name, n, f"{n} = 0", source)

    def repeated(name: str, key: str, source: str) -> str:
        n = f"(count({key}) - count(DISTINCT {key}))"
        return check(name, n, f"{n} = 0", source)

    checks = [check("raw_row_count", "count(*)", "count(*) >= 1", "raw")]
    for column, limit in (("NAME", 0), ("TRANSACTION_AMT", 0), ("TRANSACTION_DT", 0), ("SUB_ID", 0), ("ZIP_CODE", 1)):
        rate = _pct(f"count(*) FILTER ({_is_blank(column)})", "count(*)")
        checks.append(check(f"raw_null_rate_{column}", rate, f"{rate} <= {limit}", "raw"))
    all_blank = " AND ".join(_is_blank(c) for c in SOURCE_COLUMNS)
    checks += [
        violations("raw_empty_rows", all_blank, "raw"),
        violations("raw_null_load_date", "_load_date IS NULL", "raw"),
        check(
            "raw_single_load_date",
            "CASE WHEN count(DISTINCT _load_date) > 1 THEN 1 ELSE 0 END",
            "count(DISTINCT _load_date) = 1",
            "raw",
        ),
        check("staging_row_count", "count(*)", "count(*) >= 1", "staged"),
        violations("staging_zip_shape", "length(zip_normalized) NOT IN (0, 5)", "staged"),
        violations("staging_name_shape", "regexp_matches(donor_name_normalized, '[A-Z,.]|  |^ | $')", "staged"),
        violations("staging_address_shape", "regexp_matches(donor_address_normalized, '[A-Z,.]')", "staged"),
        violations("staging_only_individuals", "entity_type <> 'IND'", "staged"),
        violations("staging_null_load_date", "load_date IS NULL", "staged"),
        check("staging_blank_names", "count(*) FILTER (donor_name_normalized = '')", "TRUE", "staged"),
        repeated("staging_unique_sub_id", "sub_id", "staged"),
        check(
            "staging_not_more_than_raw",
            "greatest(count(*) - (SELECT count(*) FROM raw), 0)",
            "count(*) <= (SELECT count(*) FROM raw)",
            "staged",
        ),
        check("identity_row_count", "count(*)", "count(*) >= 1", "dim"),
        violations("identity_null_donor_id", "donor_id IS NULL", "dim"),
        violations("identity_unknown_rule", "match_rule NOT IN ('rule1', 'rule2', 'no_match')", "dim"),
        repeated("identity_unique_sub_id", "sub_id", "dim"),
        violations("identity_covers_staging", "sub_id NOT IN (SELECT sub_id FROM dim)", "staged"),
        check("mart_row_count", "count(*)", "count(*) >= 1", "mart"),
        violations("mart_score_range", "engagement_score NOT BETWEEN 1 AND 5", "mart"),
        violations("mart_no_gifts", "contribution_count < 1", "mart"),
        repeated("mart_unique_donor_id", "donor_id", "mart"),
    ]
    checks += [f"SELECT '{name}_schema', 0.0::DOUBLE, TRUE" for name in ("raw", "staging", "identity", "mart")]
    return _over_mart("\nUNION ALL\n".join(checks))


def _daily_run() -> str:
    tasks = (
        ("ingest_raw", "raw_rows", "raw_rows"), ("check_raw", "raw_rows", "raw_rows"),
        ("build_staging", "raw_rows", "staged_rows"), ("check_staging", "staged_rows", "staged_rows"),
        ("build_identity_layer", "staged_rows", "staged_rows"), ("check_identity", "staged_rows", "staged_rows"),
        ("build_mart", "staged_rows", "mart_rows"), ("check_mart", "mart_rows", "mart_rows"),
    )
    counts = """
        SELECT _load_date AS day, count(*) AS raw_rows, count(*) FILTER (ENTITY_TP = 'IND') AS staged_rows,
          (SELECT count(DISTINCT donor_id) FROM dim WHERE dim.load_date <= raw._load_date) AS mart_rows
        FROM raw GROUP BY _load_date"""
    rows = [
        f"SELECT day AS execution_date, '{t}' AS task_name, {i} AS row_count_input, {o} AS row_count_output, 'PASS' AS status FROM counts"
        for t, i, o in tasks
    ]
    return _with("\nUNION ALL\n".join(rows), **STAGED, **_identity("staged"), counts=counts)


FINGERPRINT_COLUMNS = (
    "sub_id cmte_id tran_id name_raw city_raw state zip_raw donor_name_normalized donor_address_normalized "
    "zip_normalized contribution_amount contribution_date entity_type load_date"
).split()

GOOD_LINE = "MEMO_CD IS NULL"

ORACLES: dict[str, str] = {
    "filter_individuals": _with(
        """SELECT count(*) AS rows_before, count(*) FILTER (ENTITY_TP = 'IND') AS rows_after,
             count(*) FILTER (ENTITY_TP <> 'IND') AS rows_removed FROM raw"""
    ),
    "raw_partition_counts": _with(PER_DAY),
    "raw_reconcile": _with(
        "SELECT _load_date AS load_date, count(*) AS rows_in, count(*) AS rows_out, 'PASS' AS status FROM raw GROUP BY 1"
    ),
    "partition_overwrite": _with(PER_DAY),
    "raw_partition_read": _with(
        f"SELECT {', '.join(SOURCE_COLUMNS)}, _load_date AS load_date FROM raw WHERE _load_date = DATE '2025-01-02'"
    ),
    "raw_unknown_columns": _with(
        f"""SELECT SUB_ID, _load_date AS load_date, 'ORIGIN' AS column_name, 'origin ' || FILE_NUM AS value, 'string' AS column_type
              FROM raw WHERE _load_date > {DAY_1}
            UNION ALL
            SELECT SUB_ID, _load_date, 'AMOUNT_IN_CENTS', CAST(CAST(TRANSACTION_AMT * 100 AS BIGINT) AS STRING), 'bigint'
              FROM raw WHERE _load_date = {DAY_3}"""
    ),
    "csv_roundtrip": _with(f"SELECT {TEXT_COLUMNS} FROM raw"),
    "malformed_rows": _with(
        f"""SELECT count(*) AS total_rows, count(*) FILTER (NOT {GOOD_LINE}) AS skipped_rows,
             least(count(*) FILTER ({GOOD_LINE}), 10000) AS sampled_rows FROM raw"""
    ),
    "malformed_null_profile": _with(f"SELECT column_name, null_count, null_pct FROM ({_null_counts(GOOD_LINE)})"),
    "schema_select": _with("SELECT SUB_ID, NAME, ZIP_CODE, TRANSACTION_DT, TRANSACTION_AMT FROM raw"),
    "sample_first_n": _with(f"SELECT {', '.join(SOURCE_COLUMNS)} FROM raw ORDER BY SUB_ID LIMIT 10000"),
    "normalize_names": _with(f"SELECT SUB_ID AS sub_id, NAME AS raw, {_name('NAME')} AS normalized FROM raw"),
    "normalize_addresses": _with(
        f"SELECT SUB_ID AS sub_id, {CITY_STATE} AS raw, {_address(CITY_STATE)} AS normalized FROM raw"
    ),
    "normalize_zips": _with(f"SELECT SUB_ID AS sub_id, ZIP_CODE AS raw, {_zip('ZIP_CODE')} AS normalized FROM raw"),
    "parse_contribution_dates": _with(
        f"SELECT SUB_ID AS sub_id, {_date('TRANSACTION_DT')} AS contribution_date FROM raw"
    ),
    "parse_dates_lenient": _with(
        f"""SELECT SUB_ID AS sub_id,
             CASE WHEN length(t) = 8 THEN {_date("t")}
                  WHEN substr(t, 1, 2) IN ('10', '11', '12') AND substr(t, 3, 1) <> '0' THEN
                    CAST(try_strptime(substr(t, 1, 2) || '0' || substr(t, 3), '%m%d%Y') AS DATE)
                  ELSE CAST(try_strptime('0' || t, '%m%d%Y') AS DATE) END AS lenient,
             {_date("t")} AS strict
           FROM (SELECT SUB_ID, regexp_replace(TRANSACTION_DT, '^0', '') AS t FROM raw)"""
    ),
    "unparseable_dates": _with(
        "SELECT count(*) FILTER (contribution_date IS NULL) AS unparseable_dates FROM staged", **STAGED
    ),
    "safe_cast_amount": _with(
        """SELECT SUB_ID AS sub_id, TRY_CAST(CASE WHEN AMNDT_IND = 'A' THEN 'None'
             ELSE CAST(TRANSACTION_AMT AS STRING) END AS DECIMAL(18,2)) AS contribution_amount FROM raw"""
    ),
    "parse_iso_dates": _with(
        """SELECT SUB_ID AS sub_id, TRY_CAST(CASE WHEN AMNDT_IND = 'A' THEN 'None'
             ELSE CAST(_load_date AS STRING) END AS DATE) AS load_date FROM raw"""
    ),
    "staging_rows": _with("SELECT * FROM staged", **STAGED),
    "staging_upsert": _with(_upserted("staged", "resent"), **STAGED, **RESENT),
    "staging_upsert_table": _with(_upserted("staged", "resent"), **STAGED, **RESENT),
    "upsert_fallback_key": _with(
        f"""
        SELECT {FALLBACK} FROM earlier e WHERE NOT EXISTS (SELECT 1 FROM batch b
          WHERE b.donor_name_normalized = e.donor_name_normalized AND b.contribution_date = e.contribution_date
            AND b.contribution_amount = e.contribution_amount)
        UNION ALL SELECT {FALLBACK} FROM batch""",
        **STAGED,
        earlier=f"SELECT {FALLBACK} FROM staged WHERE load_date < {DAY_3}",
        batch=f"""
            SELECT {FALLBACK} FROM staged WHERE load_date = {DAY_3}
            QUALIFY contribution_date IS NULL OR contribution_amount IS NULL OR row_number() OVER (
              PARTITION BY donor_name_normalized, contribution_date, contribution_amount ORDER BY sub_id) = 1""",
    ),
    "rule1_keys": _over_identity("SELECT sub_id, canonical_key FROM keyed WHERE match_rule = 'rule1'"),
    "rule2_keys": _over_identity("SELECT sub_id, canonical_key, match_rule FROM keyed WHERE match_rule <> 'rule1'"),
    "identity_resolution": _over_identity("SELECT * FROM dim"),
    "identity_all_dates": _over_identity("SELECT * FROM dim", scope="all"),
    "identity_route_conflicts": _over_identity(
        "SELECT sub_id, donor_id, 'rule2_multiple_candidates' AS conflict_reason FROM dim WHERE identity_conflict",
        route=True,
    ),
    "identity_zero_zip_null": _over_identity("SELECT sub_id, donor_id, match_rule FROM dim", zero_is_null=True),
    "dim_upsert": _with(
        _upserted("first_dim", "dim"),
        **STAGED,
        **RESENT,
        **{f"first_{name}": _prefixed(text) for name, text in _identity("staged").items()},
        **_identity("resent"),
    ),
    "identity_tables": _over_identity(
        """SELECT load_date, count(*) AS dim_rows, count(*) FILTER (identity_conflict) AS conflicts,
             count(*) FILTER (identity_conflict) AS review_rows FROM dim GROUP BY load_date""",
        route=True,
    ),
    "identity_rebuild": _over_identity("SELECT * FROM dim", scope="all"),
    "day_resent": _with(
        "SELECT * FROM dim",
        left_over="SELECT * FROM raw WHERE NOT (_load_date = DATE '2025-01-02' AND AMNDT_IND = 'A')",
        staged=_staged_from("left_over"),
        **_identity("staged"),
    ),
    "daily_run": _daily_run(),
    "fixture_identity": _over_identity("SELECT sub_id, donor_id, match_rule FROM dim", scope="all"),
    "match_rule_distribution": _over_identity(
        """SELECT match_rule, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS pct
           FROM dim GROUP BY match_rule"""
    ),
    "donor_lookup": _over_identity(
        f"SELECT sub_id, donor_id FROM dim WHERE sub_id = '1230' AND load_date = {DAY_1}"
    ),
    "null_profile": _with(f"SELECT column_name, null_count, null_pct FROM ({_null_counts()})"),
    "top_null_columns": _with(
        f"""SELECT column_name, null_count, null_pct FROM ({_null_counts()}) WHERE null_count > 0
            ORDER BY null_count DESC, position LIMIT 10"""
    ),
    "key_population": _key_population("SUB_ID"),
    "key_population_partial": _key_population("OTHER_ID"),
    "duplicate_profile": _with(
        f"SELECT count(*) AS unique_keys, count(*) FILTER (n > 1) AS repeated_keys FROM ({GIFTS})"
    ),
    "duplicate_examples": _with(
        f"""SELECT * FROM ({GIFTS}) WHERE n > 1 ORDER BY n DESC, NAME, TRANSACTION_DT, TRANSACTION_AMT LIMIT 5"""
    ),
    "blank_zip_rate": _with(
        f"""SELECT load_date, count(*) FILTER (zip_normalized = '') AS blank, count(*) AS total,
             {_pct("count(*) FILTER (zip_normalized = '')", "count(*)")} AS pct FROM staged GROUP BY load_date""",
        **STAGED,
    ),
    "donor_summary": _over_mart("SELECT * FROM summary"),
    "engagement_score": _over_mart(
        "SELECT donor_id, days_since_last, recency_score, frequency_score, monetary_score, engagement_score FROM mart"
    ),
    "lapsed_donors": _over_mart(
        f"""SELECT donor_id, total_amount, last_contribution_date FROM summary
            WHERE total_amount >= 500 AND last_contribution_date < CAST({AS_OF} - INTERVAL 12 MONTH AS DATE)"""
    ),
    "quality_report": _quality(),
    "table_fingerprint": _with(
        f"""SELECT count(*) AS row_count,
             CAST(sum(CAST('0x' || substr(d, 1, 16) AS UBIGINT)) AS DECIMAL(38,0)) AS hash_sum,
             CAST(sum(CAST('0x' || substr(d, 17, 16) AS UBIGINT)) AS DECIMAL(38,0)) AS hash_sum_low
           FROM (SELECT md5({" || '|' || ".join(
            f"coalesce(CAST(length(CAST({c} AS STRING)) AS STRING) || ':' || CAST({c} AS STRING), 'N')" for c in FINGERPRINT_COLUMNS
        )}) AS d FROM staged)""",
        **STAGED,
    ),
    "run_log": _with(
        """SELECT 'run-' || CAST(_load_date AS STRING) AS run_id, _load_date AS execution_date,
             'build_staging' AS task_name, count(*) AS row_count_input,
             count(*) FILTER (ENTITY_TP = 'IND') AS row_count_output, 'PASS' AS status FROM raw GROUP BY _load_date"""
    ),
}
