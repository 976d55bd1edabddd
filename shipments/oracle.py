"""The same results in plain SQL over the tables, for every query of the catalogue."""

from __future__ import annotations

# Each stage is one named subquery; a statement includes the ones it needs.
STAGES = {
    "landed": """
        SELECT CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 'DE_GHOST'
                    WHEN l_discount = 0.1 AND l_tax = 0.07 THEN NULL
                    ELSE 'DE_' || l_returnflag || l_linestatus END AS "dataElement",
               CASE WHEN l_discount = 0 AND l_tax = 0 THEN NULL
                    WHEN l_discount = 0 AND l_tax = 0.08 THEN strftime(l_shipdate, '%Y-%m')
                    ELSE strftime(l_shipdate, '%Y%m') END AS period,
               CASE WHEN l_discount = 0.1 AND l_tax = 0 THEN ''
                    WHEN l_discount = 0.1 AND l_tax = 0.01 THEN 'OU_GHOST'
                    ELSE 'OU_S' || l_suppkey END AS "orgUnit",
               CASE WHEN l_linenumber < 7 THEN 'COC_' || l_linenumber
                    ELSE 'COC_DEF' END AS "categoryOptionCombo",
               CASE WHEN l_tax = 0 THEN '0'
                    WHEN l_tax = 0.08 THEN NULL
                    WHEN l_discount = 0.05 AND l_tax = 0.07 THEN ' '
                    WHEN l_discount = 0.05 AND l_tax = 0.06 THEN 'N/A'
                    WHEN l_tax = 0.05 AND l_quantity = 50
                        THEN CAST(CAST(l_quantity AS INTEGER) * 100 AS VARCHAR)
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS value,
               strftime(CAST(l_shipdate AS DATE) + 5, '%Y-%m-%d') || 'T00:00:00.000' AS created,
               CASE WHEN l_discount = 0.03 THEN NULL
                    WHEN l_discount = 0.04
                        THEN strftime(CAST(l_shipdate AS DATE) + l_linenumber * 20, '%Y-%m-%d')
                    ELSE strftime(CAST(l_shipdate AS DATE) + l_linenumber * 20, '%Y-%m-%d')
                         || 'T00:00:00.000' END AS "lastUpdated",
               l_orderkey || '-' || l_partkey AS "storedBy"
        FROM lineitem""",
    "checked": """
        SELECT *, concat_ws('|',
                 CASE WHEN coalesce("orgUnit", '') = '' THEN 'missing:orgUnit' END,
                 CASE WHEN coalesce(period, '') = '' THEN 'missing:period'
                      WHEN NOT regexp_matches(period, '^[0-9]{6}$')
                          THEN 'invalid_period:' || period END,
                 CASE WHEN coalesce("dataElement", '') = '' THEN 'missing:dataElement' END
               ) AS quarantine_reason
        FROM landed""",
    "valid": "SELECT * EXCLUDE (quarantine_reason) FROM checked WHERE quarantine_reason = ''",
    "elements": """
        SELECT DISTINCT 'DE_' || l_returnflag || l_linestatus AS id,
               CASE WHEN l_returnflag = 'R' THEN 'DE_' || l_returnflag || l_linestatus
                    ELSE 'Lines ' || l_returnflag || ' ' || l_linestatus END AS name,
               CASE WHEN l_returnflag = 'R' THEN 'NUMBER' ELSE 'INTEGER' END AS "valueType",
               CASE WHEN l_linestatus = 'O' THEN 'TRACKER' ELSE 'AGGREGATE' END AS "domainType",
               CASE WHEN l_returnflag <> 'R' THEN 'CC_' || l_linestatus END AS "categoryComboId"
        FROM lineitem""",
    "combos": """
        SELECT DISTINCT 'COC_' || l_linenumber AS id,
               CASE WHEN l_linenumber > 1 THEN 'Line ' || l_linenumber ELSE 'COC_1' END AS name
        FROM lineitem WHERE l_linenumber <= 5""",
    "placed": """
        SELECT *, CAST(floor(s_acctbal / 2500) AS INTEGER) AS band
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "units": """
        SELECT 'OU_R' || r_regionkey AS id, r_name AS name, 1 AS level,
               '/OU_R' || r_regionkey AS path, CAST(NULL AS VARCHAR) AS "parentId"
        FROM region
        UNION ALL
        SELECT 'OU_N' || n_nationkey, n_name, 2,
               '/OU_R' || n_regionkey || '/OU_N' || n_nationkey, 'OU_R' || n_regionkey
        FROM nation
        UNION ALL
        SELECT DISTINCT 'OU_N' || n_nationkey || 'B' || band, n_name || ' band ' || band, 3,
               '/OU_R' || n_regionkey || '/OU_N' || n_nationkey
                   || '/OU_N' || n_nationkey || 'B' || band,
               'OU_N' || n_nationkey
        FROM placed
        UNION ALL
        SELECT 'OU_S' || s_suppkey,
               CASE WHEN s_acctbal >= 0 THEN s_name ELSE 'OU_S' || s_suppkey END, 4,
               CASE WHEN s_acctbal BETWEEN 4000 AND 4100 THEN '/OU_S' || s_suppkey
                    ELSE '/OU_R' || n_regionkey || '/OU_N' || n_nationkey
                         || '/OU_N' || n_nationkey || 'B' || band || '/OU_S' || s_suppkey END,
               CASE WHEN s_acctbal BETWEEN 4000 AND 4100 THEN NULL
                    ELSE 'OU_N' || n_nationkey || 'B' || band END
        FROM placed""",
    "tree": """
        SELECT u.id, u.name AS facility_name, u.level AS facility_level, u.path AS ou_path,
               c.name AS country_name, r.name AS region_name, d.name AS district_name
        FROM units u
        LEFT JOIN units c ON c.level = 1 AND c.id = split_part(u.path, '/', 2)
        LEFT JOIN units r ON r.level = 2 AND r.id = split_part(u.path, '/', 3)
        LEFT JOIN units d ON d.level = 3 AND d.id = split_part(u.path, '/', 4)""",
    "programme_records": """
        SELECT 'PR_RET_' || r_regionkey AS id, 'PR_RET_' || r_regionkey AS name,
               'Returns' AS "healthArea", r_name AS country,
               ['DE_RF', 'DE_RO', 'DE_AF', 'DE_AO'] AS listed
        FROM region
        UNION ALL
        SELECT 'PR_SAL_' || r_regionkey, 'Sales ' || r_name, 'Sales', r_name,
               CASE WHEN r_name <> 'ASIA' THEN ['DE_NF', 'DE_NO'] END
        FROM region
        UNION ALL
        SELECT 'PR_AUD_' || r_regionkey, 'PR_AUD_' || r_regionkey, 'Audit', r_name, ['DE_RF']
        FROM region WHERE r_name = 'EUROPE'""",
    "bridge": """
        SELECT unnest(listed) AS de_id, id AS program_id, "healthArea" AS health_area, country
        FROM programme_records""",
    "known": """
        SELECT v.*, e.name AS data_element_name, e."valueType", e."domainType"
        FROM valid v JOIN elements e ON v."dataElement" = e.id""",
    "described": """
        SELECT k.*, coalesce(c.name, 'Default') AS coc_name, c.id IS NULL AS is_orphaned_coc
        FROM known k LEFT JOIN combos c ON k."categoryOptionCombo" = c.id""",
    "resolved": """
        SELECT d.*, t.* EXCLUDE (id) FROM described d JOIN tree t ON d."orgUnit" = t.id""",
    "timed": """
        SELECT *,
               coalesce(try_strptime(substr("lastUpdated", 1, 23), '%Y-%m-%dT%H:%M:%S.%g'),
                        try_strptime(substr("lastUpdated", 1, 10), '%Y-%m-%d')) AS updated_ts,
               coalesce(try_strptime(substr(created, 1, 23), '%Y-%m-%dT%H:%M:%S.%g'),
                        try_strptime(substr(created, 1, 10), '%Y-%m-%d')) AS created_ts
        FROM resolved""",
    "latest": """
        SELECT * FROM timed
        QUALIFY row_number() OVER (
            PARTITION BY "dataElement", period, "orgUnit", "categoryOptionCombo"
            ORDER BY updated_ts DESC NULLS LAST, created_ts DESC NULLS LAST,
                     "lastUpdated" DESC NULLS LAST, created DESC NULLS LAST,
                     value DESC NULLS LAST, "storedBy" DESC NULLS LAST) = 1""",
    "cleaned": """
        SELECT * EXCLUDE (updated_ts, created_ts),
               coalesce(value = '0', false) AS is_explicit_zero,
               coalesce(trim(value) = '', true) AS is_missing_value,
               TRY_CAST(value AS DOUBLE) AS typed_value,
               coalesce(date_diff('day', last_day(CAST(strptime(period, '%Y%m') AS DATE)),
                   CAST(coalesce(updated_ts, created_ts) AS DATE)) > 60, false) AS is_late_reported
        FROM latest""",
    "limits": """
        SELECT *, q1 - 3 * (q3 - q1) AS fence_low, q3 + 3 * (q3 - q1) AS fence_high
        FROM (SELECT "dataElement", quantile_disc(typed_value, 0.25) AS q1,
                     quantile_disc(typed_value, 0.75) AS q3
              FROM cleaned GROUP BY 1)""",
    "outlying": """
        SELECT c.*, coalesce(l.q3 > l.q1 AND (c.typed_value < l.fence_low
                             OR c.typed_value > l.fence_high), false) AS is_outlier
        FROM cleaned c LEFT JOIN limits l USING ("dataElement")""",
    "fact": """
        SELECT md5(concat_ws('|', "dataElement", period, "orgUnit", "categoryOptionCombo")) AS fact_id,
               period, CAST(substr(period, 1, 4) AS INTEGER) AS year,
               CAST(substr(period, 5, 2) AS INTEGER) AS month,
               CASE WHEN substr(period, 5, 2) <= '03' THEN 'Q1'
                    WHEN substr(period, 5, 2) <= '06' THEN 'Q2'
                    WHEN substr(period, 5, 2) <= '09' THEN 'Q3' ELSE 'Q4' END AS quarter,
               substr(period, 1, 4) || '-' || substr(period, 5, 2) AS year_month,
               substr(period, 1, 4) || '-' || substr(period, 5, 2) AS date_key,
               "orgUnit" AS org_unit_id, facility_name, facility_level, ou_path, country_name,
               region_name, district_name, "dataElement" AS data_element_id, data_element_name,
               "valueType", "domainType", program_id, health_area, "categoryOptionCombo" AS coc_id,
               coc_name, is_orphaned_coc, value, typed_value, is_explicit_zero, is_missing_value,
               is_late_reported, is_outlier, created, "lastUpdated" AS last_updated, "storedBy"
        FROM outlying LEFT JOIN bridge ON "dataElement" = de_id AND country_name = country""",
    "scores": """
        SELECT a.*, e.expected_de_count,
               CAST(round(CAST(CAST(CAST(actual_de_count AS DOUBLE) / expected_de_count * 100
                    AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS completeness_pct
        FROM (SELECT country_name, "orgUnit", period,
                     count(DISTINCT "dataElement") AS actual_de_count, count(*) AS row_count
              FROM cleaned GROUP BY ALL) a
        LEFT JOIN (SELECT country_name, count(DISTINCT "dataElement") AS expected_de_count
                   FROM cleaned WHERE country_name IS NOT NULL GROUP BY 1) e USING (country_name)""",
    "scored": """
        SELECT *, CASE WHEN stddev_samp(typed_value) OVER w12 > 0
                       THEN abs(typed_value - avg(typed_value) OVER w12)
                            / stddev_samp(typed_value) OVER w12 END AS z,
               CASE WHEN lag(typed_value) OVER w > 0
                    THEN (typed_value - lag(typed_value) OVER w) / lag(typed_value) OVER w * 100
                    END AS growth
        FROM fact
        WINDOW w AS (PARTITION BY org_unit_id, data_element_id
                     ORDER BY period, coc_id, program_id NULLS FIRST, fact_id),
               w12 AS (PARTITION BY org_unit_id, data_element_id
                       ORDER BY period, coc_id, program_id NULLS FIRST, fact_id
                       ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
    "z_findings": """
        SELECT fact_id, period, country_name, facility_name, data_element_name, health_area,
               typed_value, round(z, 6) AS z_score, 'z_score_outlier' AS anomaly_type
        FROM scored WHERE z > 3""",
    "spike_findings": """
        SELECT fact_id, period, country_name, facility_name, data_element_name, health_area,
               typed_value, round(growth, 6) AS z_score, 'period_spike' AS anomaly_type
        FROM scored WHERE growth > 300""",
    "event_scored": """
        SELECT *, CASE WHEN stddev_samp(value) OVER w12 > 0
                       THEN abs(value - avg(value) OVER w12) / stddev_samp(value) OVER w12
                       END AS z,
               CASE WHEN lag(value) OVER w > 0
                    THEN (value - lag(value) OVER w) / lag(value) OVER w * 100 END AS growth
        FROM events
        WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id),
               w12 AS (PARTITION BY user_id, event_type ORDER BY ts, event_id
                       ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
    "earlier_parts": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part WHERE p_size > 5""",
    "later_parts": """
        SELECT CAST(p_partkey AS VARCHAR) AS id,
               CASE WHEN p_brand = 'Brand#13' THEN upper(p_name) ELSE p_name END AS name
        FROM part WHERE p_size <= 45""",
    "part_drift": """
        SELECT coalesce(n.id, t.id) AS element_id,
               CASE WHEN t.id IS NULL THEN n.name WHEN n.id IS NULL THEN t.name
                    ELSE t.name || ' -> ' || n.name END AS element_name,
               CASE WHEN t.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed'
                    ELSE 'renamed' END AS drift_type
        FROM later_parts n FULL JOIN earlier_parts t ON n.id = t.id
        WHERE n.name IS DISTINCT FROM t.name""",
}


def statement(select: str) -> str:
    stages = ",\n".join(f"{name} AS ({sql})" for name, sql in STAGES.items())
    return f"WITH {stages}\n{select}"


def half_up(expression: str) -> str:
    """Rounding to two places of the digits a double is written with."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


REQUIRED = """fact_id period year month quarter year_month date_key org_unit_id
              data_element_id""".split()
CONTRACTED = """fact_id period year month quarter year_month date_key org_unit_id facility_name
    country_name region_name district_name data_element_id data_element_name program_id health_area
    coc_id coc_name is_orphaned_coc value typed_value is_explicit_zero is_missing_value
    is_late_reported is_outlier""".split()


def _contract_fact() -> str:
    rows = []
    for name in CONTRACTED:
        for check in ("presence", "type"):
            rows.append(f"SELECT '{check}' AS \"check\", '{name}' AS subject, "
                        "CAST(0 AS BIGINT) AS failures, '' AS detail")
    for name in REQUIRED:
        rows.append(f"SELECT 'not_null', '{name}', count(*) FILTER (WHERE {name} IS NULL), "
                    "'null in a required column' FROM fact")
    rows += [
        "SELECT 'constraint', 'typed_value_non_negative', count(*) FILTER (WHERE typed_value < 0), "
        "'typed_value IS NULL OR typed_value >= 0' FROM fact",
        "SELECT 'constraint', 'period_format_monthly', "
        "count(*) FILTER (WHERE NOT regexp_matches(period, '^[0-9]{6}$')), "
        "'length(period) = 6 AND period rlike ''^[0-9]+$''' FROM fact",
        "SELECT 'constraint', 'fact_id_not_null', count(*) FILTER (WHERE fact_id IS NULL), "
        "'fact_id IS NOT NULL' FROM fact",
    ]
    return " UNION ALL ".join(rows)


CONTRACT_LINES = """
    SELECT * FROM (VALUES ('presence', 'l_orderkey', CAST(0 AS BIGINT)), ('type', 'l_orderkey', 0),
        ('presence', 'l_quantity', 0), ('type', 'l_quantity', 1), ('presence', 'l_comment', 1),
        ('constraint', 'no_such_column', 1)) AS v("check", subject, failures)
    UNION ALL SELECT 'not_null', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
    UNION ALL SELECT 'min', 'l_orderkey', count(*) FILTER (WHERE l_orderkey < 0) FROM lineitem
    UNION ALL SELECT 'max', 'l_quantity', count(*) FILTER (WHERE l_quantity > 49) FROM lineitem
    UNION ALL SELECT 'constraint', 'taxed', count(*) FILTER (WHERE NOT l_tax > 0) FROM lineitem
    UNION ALL SELECT 'constraint', 'null_passes',
                     count(*) FILTER (WHERE NOT nullif(l_tax, 0) >= 0.05) FROM lineitem
    UNION ALL SELECT 'min_rows', 'lines', greatest(100 - count(*), 0) FROM lineitem"""

VALUE_COLUMNS = """ "dataElement", period, "orgUnit", "categoryOptionCombo", value, created,
                    "lastUpdated", "storedBy" """
PIVOT = ", ".join(
    f"sum(typed_value) FILTER (WHERE data_element_name = '{name}') AS \"{name}\""
    for name in ("Lines A F", "Lines A O", "Lines N F", "Lines N O", "DE_RF", "DE_RO")
)

SELECTS = {
    "landing_values": f"SELECT {VALUE_COLUMNS} FROM landed",
    "landing_elements": "SELECT * FROM elements",
    "landing_combos": "SELECT * FROM combos",
    "landing_units": "SELECT * FROM units",
    "landing_programs": """SELECT id, name, "healthArea", country,
        'Monthly' AS "reportingFrequency" FROM programme_records""",
    "landing_explode_bridge": "SELECT * FROM bridge",
    "landing_json_field": "SELECT event_id, props::JSON ->> 'k' AS k FROM events",
    "quarantine_rows": """SELECT "dataElement", period, "orgUnit", "categoryOptionCombo",
        value AS raw_value, quarantine_reason FROM checked WHERE quarantine_reason <> ''""",
    "valid_rows": "SELECT * FROM valid",
    "quarantine_rate": """SELECT *, quarantined_rows::DOUBLE / total_rows * 100 AS quarantine_pct,
        quarantined_rows * 10 <= total_rows AS passed
        FROM (SELECT count(*) AS total_rows,
                     count(*) FILTER (WHERE quarantine_reason <> '') AS quarantined_rows
              FROM checked)""",
    "resolve_reject": "SELECT * FROM known",
    "resolve_rejected_rows": """SELECT * FROM valid
        WHERE "dataElement" NOT IN (SELECT id FROM elements)""",
    "resolve_flag_default": "SELECT * FROM described",
    "orphaned_combos": "SELECT * FROM described WHERE is_orphaned_coc",
    "label_documents": """SELECT d.doc_id, lang, source, n_chars,
        coalesce(CAST(quality AS VARCHAR), 'none') AS quality_label,
        l.doc_id IS NULL AS is_unlabelled
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "repeated_registry_keys": """SELECT de_id, country, count(*) AS n_rows FROM bridge
        GROUP BY ALL HAVING count(*) > 1""",
    "tree_levels": "SELECT * FROM tree",
    "resolve_units": "SELECT * FROM resolved",
    "orphaned_units": """SELECT * FROM described WHERE "orgUnit" NOT IN (SELECT id FROM units)""",
    "dedup_exact": """SELECT DISTINCT "dataElement", period, "orgUnit", "categoryOptionCombo", value
        FROM resolved""",
    "dedup_latest": f"SELECT {VALUE_COLUMNS} FROM latest",
    "dedup_latest_line": """SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "duplicate_tally": """SELECT rows_in, rows_in - n_values AS exact_duplicates,
        n_values - rows_left AS near_duplicates, rows_left
        FROM (SELECT count(*) AS rows_in FROM resolved),
             (SELECT count(*) AS n_values FROM (SELECT DISTINCT "dataElement", period, "orgUnit",
                  "categoryOptionCombo", value FROM resolved)),
             (SELECT count(*) AS rows_left FROM (SELECT DISTINCT "dataElement", period, "orgUnit",
                  "categoryOptionCombo" FROM resolved))""",
    "value_flags": """SELECT *, coalesce(value = '0', false) AS is_explicit_zero,
        coalesce(trim(value) = '', true) AS is_missing_value,
        TRY_CAST(value AS DOUBLE) AS typed_value FROM valid""",
    "late_flag": """SELECT *, coalesce(date_diff('day',
            last_day(CAST(strptime(period, '%Y%m') AS DATE)),
            CAST(substr(coalesce("lastUpdated", created), 1, 10) AS DATE)) > 60, false)
        AS is_late_reported FROM valid""",
    "outlier_limits": "SELECT * FROM limits",
    "sketched_limits": """SELECT "dataElement", count(typed_value) AS n_values,
        count(typed_value) AS n_kept, true AS q1_in_rank, true AS q3_in_rank
        FROM outlying GROUP BY ALL HAVING count(typed_value) > 0""",
    "moved_flags": """SELECT * FROM (
        SELECT o."dataElement", period, "orgUnit", "categoryOptionCombo", typed_value, is_outlier,
            coalesce(q3 > q1 AND (typed_value < q1 - 3 * (q3 - q1) OR typed_value > q3 + 3 * (q3 - q1)), false)
                AS was_outlier
        FROM outlying o LEFT JOIN (
            SELECT "dataElement", quantile_disc(typed_value, 0.25) AS q1, quantile_disc(typed_value, 0.75) AS q3
            FROM outlying WHERE period < '199901' GROUP BY 1) USING ("dataElement")
        WHERE period < '199901') WHERE was_outlier <> is_outlier""",
    "iqr_outlier": """SELECT event_id, event_type, value, true AS is_outlier
        FROM events JOIN (SELECT event_type, quantile_disc(value, 0.25) AS q1,
                                 quantile_disc(value, 0.75) AS q3 FROM events GROUP BY 1)
             USING (event_type)
        WHERE q3 > q1 AND (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1))""",
    "completeness": "SELECT * FROM scores",
    "dq_tally": """SELECT count(*) AS total_rows,
        count(*) FILTER (WHERE is_late_reported) AS late_rows,
        count(*) FILTER (WHERE is_outlier) AS outlier_rows,
        count(*) FILTER (WHERE is_explicit_zero) AS zero_rows,
        count(*) FILTER (WHERE is_missing_value) AS missing_rows,
        (SELECT round(avg(completeness_pct), 6) FROM scores) AS avg_completeness_pct
        FROM outlying""",
    "fact_build": "SELECT * FROM fact",
    "fact_nonempty": "SELECT count(*) AS fact_rows, count(*) > 0 AS passed FROM fact",
    "dim_data_element": """SELECT id AS data_element_id, name AS data_element_name,
        "valueType" AS value_type, "domainType" AS domain_type,
        "categoryComboId" AS category_combo_id FROM elements""",
    "dim_org_unit": """SELECT id AS org_unit_id, name AS org_unit_name, level AS ou_level,
        path AS ou_path, "parentId" AS parent_id FROM units""",
    "dim_program": """SELECT id AS program_id, name AS program_name, "healthArea" AS health_area,
        country, 'Monthly' AS reporting_frequency FROM programme_records""",
    "dim_period": "SELECT DISTINCT period, year, month, quarter, year_month FROM fact",
    "contract_fact": _contract_fact(),
    "contract_lines": CONTRACT_LINES,
    "loaded_period_set": "SELECT DISTINCT period FROM fact WHERE period < '199901'",
    "new_period_rows": """SELECT * FROM valid WHERE period = '199701'
        OR period NOT IN (SELECT period FROM fact WHERE period < '199901')""",
    "incremental_overwrite": """SELECT health_area, period, count(*) AS n_rows,
        sum(typed_value) AS total FROM fact GROUP BY ALL""",
    "monthly_volume": """SELECT program_id, health_area, country_name, period, year_month,
        sum(typed_value) AS total_value, count(*) AS record_count,
        count(DISTINCT org_unit_id) AS reporting_facilities FROM fact GROUP BY ALL""",
    "kpi_summary": """SELECT data_element_id, data_element_name, country_name, program_id,
        sum(typed_value) AS total, round(avg(typed_value), 6) AS mean, min(typed_value) AS min,
        max(typed_value) AS max, round(stddev_samp(typed_value), 6) AS stddev,
        count(*) AS n_records FROM fact GROUP BY ALL""",
    "period_change": f"""SELECT *, CASE WHEN prev_value <> 0 THEN
            {half_up("(district_total - prev_value) / prev_value * 100")} END AS pct_change
        FROM (SELECT *, lag(district_total) OVER (
                  PARTITION BY district_name, country_name, data_element_id, data_element_name
                  ORDER BY period) AS prev_value
              FROM (SELECT district_name, country_name, data_element_id, data_element_name, period,
                           sum(typed_value) AS district_total FROM fact GROUP BY ALL))""",
    "nation_change": f"""SELECT *, CASE WHEN prev_value <> 0 THEN
            {half_up("(total_cents - prev_value)::DOUBLE / prev_value * 100")} END AS pct_change
        FROM (SELECT *, lag(total_cents) OVER (PARTITION BY r_name, n_name ORDER BY period)
                     AS prev_value
              FROM (SELECT r_name, n_name, strftime(o_orderdate, '%Y%m') AS period,
                           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
                               AS total_cents
                    FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL))""",
    "rolling_avg": f"""SELECT org_unit_id, facility_name, country_name, data_element_id,
        data_element_name, period, year_month, typed_value,
        {half_up('''avg(typed_value) OVER (PARTITION BY org_unit_id, data_element_id
            ORDER BY period, coc_id, program_id NULLS FIRST, fact_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''')} AS rolling_3m_avg
        FROM fact""",
    "rolling_avg_by_month": f"""SELECT org_unit_id, data_element_id, period,
        {half_up("sum(total) OVER w / sum(n) OVER w")} AS rolling_3m_avg
        FROM (SELECT org_unit_id, data_element_id, period, sum(typed_value) AS total,
                     nullif(count(typed_value), 0) AS n,
                     CAST(substr(period, 1, 4) AS INTEGER) * 12
                         + CAST(substr(period, 5, 2) AS INTEGER) AS m
              FROM fact GROUP BY ALL)
        WINDOW w AS (PARTITION BY org_unit_id, data_element_id ORDER BY m
                     RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "reporting_rate": f"""SELECT f.country_name, f.period, f.reporting_facilities,
        k.total_known_facilities,
        {half_up("f.reporting_facilities::DOUBLE / k.total_known_facilities * 100")}
            AS reporting_rate_pct
        FROM (SELECT country_name, period, count(DISTINCT org_unit_id) AS reporting_facilities
              FROM fact GROUP BY ALL) f
        LEFT JOIN (SELECT country_name, count(*) AS total_known_facilities FROM tree
                   WHERE facility_level = 4 GROUP BY 1) k ON f.country_name = k.country_name""",
    "underreporters": """SELECT org_unit_id, facility_name, country_name, health_area,
        count(*) FILTER (WHERE is_explicit_zero OR is_missing_value) AS zero_or_missing_periods,
        count(*) AS total_periods,
        CAST(dense_rank() OVER (PARTITION BY health_area ORDER BY
            count(*) FILTER (WHERE is_explicit_zero OR is_missing_value) DESC) AS INTEGER) AS rank
        FROM fact GROUP BY org_unit_id, facility_name, country_name, health_area
        QUALIFY rank <= 5""",
    "country_kpis": """SELECT country_name, program_id, health_area, data_element_id,
        data_element_name, sum(typed_value) AS total, round(avg(typed_value), 6) AS mean_per_report,
        count(DISTINCT org_unit_id) AS n_facilities, count(DISTINCT period) AS n_periods
        FROM fact GROUP BY ALL""",
    "quarterly_volumes": """SELECT health_area, country_name, year, quarter,
        sum(typed_value) AS quarterly_total, count(*) AS record_count,
        count(DISTINCT org_unit_id) AS n_facilities FROM fact GROUP BY ALL""",
    "coverage_matrix": f"SELECT country_name, {PIVOT} FROM fact GROUP BY ALL",
    "coverage_matrix_found": f"SELECT country_name, {PIVOT} FROM fact GROUP BY ALL",
    "completeness_by_country": """SELECT country_name, period,
        round(avg(completeness_pct), 6) AS avg_completeness_pct, count(*) AS n_facilities
        FROM scores GROUP BY ALL""",
    "low_streaks": """SELECT "orgUnit", country_name, count(*) AS consecutive_low_periods,
        min(period) AS streak_start, max(period) AS streak_end,
        round(avg(completeness_pct), 6) AS avg_completeness_pct
        FROM (SELECT *, CAST(substr(period, 1, 4) AS INTEGER) * 12
                        + CAST(substr(period, 5, 2) AS INTEGER)
                        - row_number() OVER (PARTITION BY "orgUnit", country_name ORDER BY period)
                        AS run
              FROM scores WHERE completeness_pct < 80)
        GROUP BY "orgUnit", country_name, run HAVING count(*) >= 3""",
    "global_totals": """SELECT program_id, health_area, data_element_id, data_element_name, period,
        sum(typed_value) AS global_total, count(DISTINCT country_name) AS n_countries,
        count(DISTINCT org_unit_id) AS n_facilities FROM fact GROUP BY ALL""",
    "zscore_anomalies": "SELECT * FROM z_findings",
    "spike_anomalies": "SELECT * FROM spike_findings",
    "anomalies": "SELECT * FROM z_findings UNION ALL SELECT * FROM spike_findings",
    "event_anomalies": """SELECT event_id, user_id, event_type, value, round(z, 6) AS z_score,
        'z_score_outlier' AS anomaly_type FROM event_scored WHERE z > 3
        UNION ALL SELECT event_id, user_id, event_type, value, round(growth, 6), 'period_spike'
        FROM event_scored WHERE growth > 300""",
    "drift_baseline": """SELECT id AS element_id, name AS element_name,
        'new_baseline' AS drift_type FROM later_parts""",
    "drift_report": "SELECT * FROM part_drift",
    "drift_counts": "SELECT drift_type, count(*) AS n_elements FROM part_drift GROUP BY 1",
    "snapshot_rollforward": "SELECT * FROM later_parts",
    "sink_fact": "SELECT * FROM fact",
    "sink_csv": """SELECT "dataElement", period, nullif("orgUnit", '') AS "orgUnit",
        "categoryOptionCombo", value AS raw_value, quarantine_reason
        FROM checked WHERE quarantine_reason <> ''""",
    "run_summary": """SELECT 'complete' AS finished, total_rows, quarantined_rows,
        round(quarantined_rows::DOUBLE / total_rows * 100, 6) AS quarantine_pct,
        CAST(0 AS BIGINT) AS already_loaded_rows, unknown_element_rows, orphaned_combo_rows,
        unknown_unit_rows, resolved_rows, resolved_rows - n_values AS exact_duplicates,
        n_values - n_keys AS near_duplicates, fact_rows, late_rows, outlier_rows, zero_rows,
        missing_rows, avg_completeness_pct, anomalies, drifted_elements
        FROM (SELECT count(*) AS total_rows,
                     count(*) FILTER (WHERE quarantine_reason <> '') AS quarantined_rows FROM checked),
             (SELECT count(*) AS unknown_element_rows FROM valid
              WHERE "dataElement" NOT IN (SELECT id FROM elements)),
             (SELECT count(*) FILTER (WHERE is_orphaned_coc) AS orphaned_combo_rows,
                     count(*) FILTER (WHERE "orgUnit" NOT IN (SELECT id FROM units))
                         AS unknown_unit_rows FROM described),
             (SELECT count(*) AS resolved_rows FROM resolved),
             (SELECT count(*) AS n_values FROM (SELECT DISTINCT "dataElement", period, "orgUnit",
                  "categoryOptionCombo", value FROM resolved)),
             (SELECT count(*) AS n_keys, count(*) FILTER (WHERE is_late_reported) AS late_rows,
                     count(*) FILTER (WHERE is_outlier) AS outlier_rows,
                     count(*) FILTER (WHERE is_explicit_zero) AS zero_rows,
                     count(*) FILTER (WHERE is_missing_value) AS missing_rows FROM outlying),
             (SELECT count(*) AS fact_rows FROM fact),
             (SELECT round(avg(completeness_pct), 6) AS avg_completeness_pct FROM scores),
             (SELECT count(*) FILTER (WHERE z > 3) + count(*) FILTER (WHERE growth > 300)
                  AS anomalies FROM scored),
             (SELECT count(*) AS drifted_elements FROM elements)""",
    "run_incremental": """SELECT country_name, quarter, year, count(*) AS n_rows,
        sum(typed_value) AS total, count(*) FILTER (WHERE is_late_reported) AS n_late
        FROM fact GROUP BY ALL""",
}

# A load in two steps gives what one load gives.
SELECTS["run_incremental_fact"] = SELECTS["fact_build"]
SELECTS["run_released_fact"] = SELECTS["fact_build"]
SELECTS["run_incremental_scores"] = SELECTS["completeness"]
SELECTS["run_incremental_kpis"] = SELECTS["country_kpis"]
SELECTS["run_incremental_quarterly"] = SELECTS["quarterly_volumes"]
SELECTS["run_incremental_matrix"] = SELECTS["coverage_matrix"]
SELECTS["run_incremental_global"] = SELECTS["global_totals"]
SELECTS["run_incremental_monthly"] = SELECTS["monthly_volume"]
SELECTS["run_incremental_rate"] = SELECTS["reporting_rate"]

# The first of two releases holds the months before the cutoff, the second all of them.
_BY_COUNTRY = """AS "release", country_name, count(*) AS n_rows, sum(typed_value) AS total,
    max(period) AS last_period FROM fact"""
SELECTS["run_release_history"] = (
    f"SELECT 1 {_BY_COUNTRY} WHERE period < '199901' GROUP BY country_name"
    f" UNION ALL SELECT 2 {_BY_COUNTRY} GROUP BY country_name"
)

# The same results by the branches that split what is too large for a task.
for plain in ("outlier_limits", "rolling_avg", "anomalies"):
    SELECTS[f"{plain}_split"] = SELECTS[plain]

ORACLE = {name: statement(select) for name, select in SELECTS.items()}
