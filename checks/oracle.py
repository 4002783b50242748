"""SQL counterparts of the registered queries, in plain SQL over the test tables.

Written from the definitions, not from the Spark plans: joins where Spark sweeps, chained
outer joins where it stacks, distinct counts where it uses bits.
"""

from __future__ import annotations

import re

from accountpulse.sources.contracts import EXPORTS as CONTRACTS
from accountpulse.sources.standins import STANDINS, standin_sql

START = "1996-01-01"
EVENTS_START = "2024-01-03"
AS_OF = "2024-02-04"
LICENCE_AS_OF = "2001-12-16"
SOME_WEEK = "DATE '1998-06-07'"
APP_WEEK = "DATE '2024-01-14'"

# The conversation types that are billed.
BILLED_TYPES = ["MARKETING", "MARKETING_LITE", "UTILITY", "AUTHENTICATION"]
STAGES = ["document_check", "liveness", "facematch"]
STATUSES = ["Approved", "Disapproved", "Fraud"]
PLANS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", *[f"Brand#{i}" for i in range(1, 26)]]
APPS = {
    "marketplace_app_hubspot": (["HubSpot", "Hubspot"], "HubSpot"),
    "marketplace_app_sap_s_4hana_cloud": (["SAP S/4HANA Cloud"], "SAP S 4HANA Cloud"),
    "marketplace_app_my_mcp_server": (["my-mcp-server"], "My MCP Server"),
    **{f"marketplace_app_nation_{i}": ([f"NATION_{i}"], f"Nation {i}") for i in range(4, 8)},
}
PLAN_COLUMNS = {"connect_plan_" + p.lower().replace("#", "_"): p for p in PLANS}
KYC_STATUS = {f"kyc_{s}_{t.lower()}": (s, t) for s in STAGES for t in STATUSES}
KYC_TOTALS = {f"kyc_{s}_total": s for s in STAGES}
HIL = {"doccheck": "document_check", "liveness": "liveness", "facematch": "facematch"}
HIL_GOV = [
    "kyc_sessions_total",
    "gov_validated",
    "gov_not_validated",
    *[f"hil_{s}_{k}" for s in HIL for k in ("total", "approved", "disapproved")],
]
SIGNUPS = ["signups", "self_service", "enterprise", "other_plans"]
METRICS = [
    "execution_count",
    "MARKETING",
    "UTILITY",
    "AUTHENTICATION",
    "dau_count",
    "unique_users_count",
    "connect_licenses",
    *PLAN_COLUMNS,
    *KYC_STATUS,
    *KYC_TOTALS,
    "kyc_total",
    *HIL_GOV,
    "marketplace_install_total",
    *APPS,
]


def week(ts: str) -> str:
    return f"(CAST({ts} AS DATE) + CAST(7 - isodow(CAST({ts} AS DATE)) AS INTEGER))"


def month(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m')"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def quoted(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def total(condition: str, value: str = "1") -> str:
    return big(f"SUM(CASE WHEN {condition} THEN {value} ELSE 0 END)")


# --- Common table expressions -----------------------------------------------

VIEWS = {name: standin_sql(name) for name in STANDINS}


INTERNAL = ["impersonate", "test", "prueba"]


def external(column: str) -> str:
    """Missing, empty, or free of every internal word."""
    words = " AND ".join(f"lower({column}) NOT LIKE '%{word}%'" for word in INTERNAL)
    return f"({column} IS NULL OR {column} = '' OR ({words}))"


# Companies without an internal word in any of their texts or in a live root user's mail.
OUTSIDE = f"""(SELECT * FROM companies c
    WHERE {external('name')} AND {external('slug')} AND {external('email')}
      AND NOT EXISTS (SELECT 1 FROM company_users u WHERE u.companyId = c.id AND u.deletedAt IS NULL
                      AND u.isRoot = 1 AND NOT {external('u.email')}))"""

STAGE_LIST = quoted(STAGES)


def count_where(condition: str) -> str:
    return f"COUNT(*) FILTER ({condition})"


def billing_sql(start: str) -> str:
    return f"""SELECT companyId, {week('createdAt')} AS week_end_sunday, conversationType,
        COUNT(*) AS event_count, {big('SUM(isBillable)')} AS billable_count
        FROM billing_events
        WHERE createdAt >= '{start}' AND companyId IS NOT NULL AND conversationType IN ({quoted(BILLED_TYPES)})
        GROUP BY ALL"""


def signups_sql(start: str) -> str:
    return f"""SELECT {week('createdAt')} AS week_end_sunday, COUNT(*) AS signups,
        {count_where("plan = 'SELF_SERVICE'")} AS self_service, {count_where("plan = 'ENTERPRISE'")} AS enterprise,
        {count_where("plan NOT IN ('SELF_SERVICE', 'ENTERPRISE')")} AS other_plans
        FROM {OUTSIDE} o WHERE createdAt >= '{start}' GROUP BY ALL"""


def owned_steps(start: str) -> str:
    """Steps of the three stages in sessions of a known company, with the government answer."""
    return f"""(SELECT b.companyId, CONCAT('Company ', b.companyId) AS companyName,
        {week('s.createdAt')} AS week_end_sunday, s.biometricId, s.stepName, s.status,
        s.enableHumanInLoop = 1 AS reviewed, d.entityResponse AS answer
        FROM biometrics b JOIN biometric_steps s ON b.id = s.biometricId AND b.companyId IS NOT NULL
        LEFT JOIN document_check_steps d ON d.id = s.documentCheckId
        WHERE s.createdAt >= '{start}' AND s.stepName IN ({STAGE_LIST})) steps"""


def kyc_sql(start: str) -> str:
    return f"""SELECT companyId, companyName, week_end_sunday, stepName, status, COUNT(*) AS kyc_steps_count
        FROM {owned_steps(start)} GROUP BY ALL"""


def hil_sql(start: str) -> str:
    review = ", ".join(
        f"{count_where(f'reviewed AND stepName = {stage!r}{outcome}')} AS hil_{short}_{kind}"
        for short, stage in HIL.items()
        for kind, outcome in (
            ("total", ""),
            ("approved", " AND status = 'Approved'"),
            ("disapproved", " AND status = 'Disapproved'"),
        )
    )
    return f"""SELECT companyId, companyName, week_end_sunday, COUNT(DISTINCT biometricId) AS kyc_sessions_total,
        {count_where("stepName = 'document_check' AND answer = 1")} AS gov_validated,
        {count_where("stepName = 'document_check' AND answer = 0")} AS gov_not_validated, {review}
        FROM {owned_steps(start)} GROUP BY ALL"""


def items_sql(as_of: str) -> str:
    return f"""SELECT company_id AS companyId, name AS plan_tier_name,
        COALESCE(NULLIF(display_name, ''), name, 'Unknown Plan') AS plan_tier_display_name,
        CAST(current_period_start AS DATE) AS period_start,
        CAST(COALESCE(canceled_at, cancel_at, current_period_end, DATE '{as_of}') AS DATE) AS period_end,
        COALESCE(NULLIF(quantity, 0), 1) AS license_qty
        FROM plan_tiers t, subscription_items i, subscriptions s
        WHERE t.id = plan_tier_id AND s.id = subscription_id AND platform_product_id = 'connect'
          AND UPPER(s.status) = 'ACTIVE' AND company_id IS NOT NULL"""


def licences_sql(start: str, as_of: str) -> str:
    return f"""SELECT wc.week_end_sunday, ci.companyId, ci.plan_tier_name, ci.plan_tier_display_name,
        {big('SUM(ci.license_qty)')} AS connect_licenses
        FROM (SELECT CAST(unnest(generate_series({week(f"DATE '{start}'")},
                {week(f"(DATE '{as_of}' + 14)")}, INTERVAL 7 DAY)) AS DATE) AS week_end_sunday) wc
        JOIN ({items_sql(as_of)}) ci ON wc.week_end_sunday BETWEEN ci.period_start AND ci.period_end GROUP BY ALL"""


def installs_sql(start: str) -> str:
    return f"""SELECT i.id AS installation_id, userId, userType, installedByUserId,
        CAST(CASE WHEN UPPER(userType) = 'ORGANIZATION' THEN installedByUserId ELSE userId END AS VARCHAR)
            AS mapping_user_id,
        appId, name AS app_name, createdAt AS installed_at, CAST(createdAt AS DATE) AS installed_date,
        {week('createdAt')} AS week_end_sunday, updatedAt
        FROM apps a JOIN user_app_installations i ON i.appId = a.id AND i.deletedAt IS NULL
        WHERE createdAt >= '{start}'"""


NUMERIC_MAP = "(SELECT userId, companyId FROM user_company_map WHERE TRY_CAST(companyId AS DOUBLE) IS NOT NULL)"

MARKETPLACE = f"""SELECT m.companyId, i.week_end_sunday, i.app_name, COUNT(*) AS marketplace_install_count,
    CASE i.app_name {' '.join(f"WHEN '{n}' THEN '{c}'" for c, (names, _) in APPS.items() for n in names)} END
        AS marketplace_col
    FROM ({installs_sql(START)}) i JOIN {NUMERIC_MAP} m ON m.userId = i.mapping_user_id GROUP BY ALL"""


def workflow_sql(start: str) -> str:
    return f"""SELECT company_id AS companyId, company_name AS companyName, {week('createdAt')} AS week_end_sunday,
        {big('SUM(total)')} AS execution_count FROM workflow_logs
        WHERE createdAt >= '{start}' AND company_id IS NOT NULL GROUP BY ALL"""


def dau_sql(start: str) -> str:
    return f"""SELECT companyId, {week('createdAt')} AS week_end_sunday,
        COUNT(DISTINCT (CAST(createdAt AS DATE), referenceId)) AS dau_count,
        COUNT(DISTINCT referenceId) AS unique_users_count FROM ai_users
        WHERE createdAt >= '{start}' AND companyId IS NOT NULL AND referenceId IS NOT NULL GROUP BY ALL"""


EXPORTS = {
    "x_workflow": workflow_sql(START),
    "x_billing": billing_sql(START),
    "x_dau": dau_sql(START),
    "x_connect": licences_sql(START, AS_OF),
    "x_kyc": kyc_sql(START),
    "x_hil": hil_sql(START),
    "x_marketplace": MARKETPLACE,
    "x_signups": signups_sql(START),
}

KEY = "CAST(companyId AS VARCHAR) AS companyId, week_end_sunday"

PREPARED = {
    "p_workflow": f"""SELECT {KEY}, MIN(companyName) AS companyName, {big('SUM(execution_count)')} AS execution_count
        FROM x_workflow GROUP BY ALL""",
    "p_billing": f"""SELECT {KEY},
        {total("conversationType IN ('MARKETING', 'MARKETING_LITE')", 'billable_count')} AS "MARKETING",
        {total("conversationType = 'UTILITY'", 'billable_count')} AS "UTILITY",
        {total("conversationType = 'AUTHENTICATION'", 'billable_count')} AS "AUTHENTICATION"
        FROM x_billing GROUP BY ALL""",
    "p_dau": f"""SELECT {KEY}, {big('SUM(dau_count)')} AS dau_count, {big('SUM(unique_users_count)')}
        AS unique_users_count FROM x_dau GROUP BY ALL""",
    "p_connect": f"""SELECT {KEY},
        {", ".join(f"{total(f'''plan_tier_display_name = '{p}' ''', 'connect_licenses')} AS {c}" for c, p in PLAN_COLUMNS.items())},
        {big('SUM(connect_licenses)')} AS connect_licenses,
        string_agg(DISTINCT plan_tier_display_name, ', ' ORDER BY plan_tier_display_name) AS connect_plan_list
        FROM x_connect GROUP BY ALL""",
    "p_kyc": f"""SELECT {KEY},
        {", ".join(f"{total(f'''stepName = '{s}' AND status = '{t}' ''', 'kyc_steps_count')} AS {c}" for c, (s, t) in KYC_STATUS.items())},
        {", ".join(f"{total(f'''stepName = '{s}' ''', 'kyc_steps_count')} AS {c}" for c, s in KYC_TOTALS.items())},
        {big('SUM(kyc_steps_count)')} AS kyc_total FROM x_kyc GROUP BY ALL""",
    "p_hil": f"SELECT {KEY}, {', '.join(HIL_GOV)} FROM x_hil",
    "p_marketplace": f"""SELECT {KEY},
        {", ".join(f"{total(f'app_name IN ({quoted(names)})', 'marketplace_install_count')} AS {c}" for c, (names, _) in APPS.items())},
        {big('SUM(marketplace_install_count)')} AS marketplace_install_total FROM x_marketplace GROUP BY ALL""",
    "p_signups": "SELECT * FROM x_signups",
}


def _merged(last: str) -> str:
    joins = " FULL OUTER JOIN ".join(
        f"{p} USING (companyId, week_end_sunday)" if i else p
        for i, p in enumerate(p for p in PREPARED if p != "p_signups")
    )
    numbers = ", ".join(f"COALESCE({m}, 0) AS {m}" for m in METRICS + SIGNUPS)
    return f"""SELECT companyId, COALESCE(companyName, 'Unknown') AS companyName, week_end_sunday, {numbers},
        COALESCE(connect_plan_list, '') AS connect_plan_list
        FROM ({'SELECT * FROM ' + joins}) k LEFT JOIN p_signups USING (week_end_sunday)
        WHERE week_end_sunday <= DATE '{last}'"""


MERGED = {"merged": _merged(AS_OF)}


def change(metric: str, period: str = "week_end_sunday", by: str = "PARTITION BY companyId") -> str:
    previous = f"LAG({metric}) OVER ({by} ORDER BY {period})"
    return f"""CASE WHEN {previous} = 0 THEN CASE WHEN {metric} > 0 THEN CAST('Infinity' AS DOUBLE) END
        ELSE (CAST({metric} AS DOUBLE) / CAST({previous} AS DOUBLE) - 1) * 100 END"""


def rate(part: str, whole: str) -> str:
    return f"COALESCE(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100, 0)"


WEEKLY = {
    "weekly": f"""SELECT week_end_sunday, {", ".join(f"{big(f'SUM({m})')} AS {m}" for m in METRICS)},
        {", ".join(f"MAX({m}) AS {m}" for m in SIGNUPS)} FROM merged GROUP BY ALL"""
}
MONTHLY = {
    **WEEKLY,
    "monthly": f"""SELECT CAST(date_trunc('month', week_end_sunday) AS DATE) AS month_start,
        {", ".join(f"{big(f'SUM({m})')} AS {m}" for m in METRICS + SIGNUPS)} FROM weekly GROUP BY ALL""",
}
RATES = {
    "rates": f"""SELECT *, gov_validated + gov_not_validated AS gov_total_queries,
        {" + ".join(f"hil_{s}_total" for s in HIL)} AS hil_total_steps,
        {rate('gov_validated', '(gov_validated + gov_not_validated)')} AS gov_validation_rate_pct,
        {rate('(' + " + ".join(f"hil_{s}_total" for s in HIL) + ')', 'kyc_total')} AS hil_derivation_pct,
        {", ".join(f"{rate(f'hil_{s}_{k}', f'hil_{s}_total')} AS hil_{s}_{r}_rate_pct" for s in HIL
                   for k, r in (('approved', 'approval'), ('disapproved', 'disapproval')))} FROM merged"""
}
CHANGED = {
    "changed": f"""SELECT *, {", ".join(f"{change(m)} AS {m}_wow" for m in
        ('execution_count', 'MARKETING', 'dau_count', 'connect_licenses', 'kyc_total', 'gov_validated'))} FROM merged"""
}

CHAIN = {**EXPORTS, **PREPARED, **MERGED}


def sql(body: str, *layers: dict[str, str]) -> str:
    """``body`` behind the CTEs it needs: stand-in views, then the given layers, as referenced."""
    ctes = {**VIEWS}
    for layer in layers:
        ctes |= layer
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(ctes[name])

    visit(body)
    used = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items() if name in needed)
    return f"WITH {used}\n{body}" if used else body


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"(FROM|JOIN|,)\s+\(?\s*{name}\b", text) is not None


def on_merged(body: str, *layers: dict[str, str]) -> str:
    return sql(body, CHAIN, *layers)


TIE = "TRY_CAST(companyId AS DECIMAL(38, 0)) NULLS LAST, companyId"
CHANGE_METRICS = ["execution_count", "MARKETING", "dau_count", "connect_licenses"]
CHANGES = ", ".join(f"{m}, {m}_wow" for m in CHANGE_METRICS)


def label_case(column: str) -> str:
    labels = {c: label for c, (_, label) in APPS.items()}
    labels |= {c: p.title().replace("#", " ") for c, p in PLAN_COLUMNS.items()}
    labels |= {c: s.replace("_", " ").title() for c, s in KYC_TOTALS.items()}
    labels |= {c: f"{s} {t}".replace("_", " ").title() for c, (s, t) in KYC_STATUS.items()}
    labels |= {c: c for c in ("MARKETING", "UTILITY", "AUTHENTICATION")}
    return f"CASE {column} {' '.join(f'''WHEN '{c}' THEN '{label}' ''' for c, label in labels.items())} END"


def unpivot(columns, table: str, keys: str, name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c}' AS {name}, {big(c)} AS value FROM {table}" for c in columns
    )


def selected(value: str) -> str:
    """Each company's row of a week, or its newest row."""
    return f"""SELECT * FROM merged QUALIFY ROW_NUMBER() OVER (PARTITION BY companyId
        ORDER BY (week_end_sunday = {value}) DESC, week_end_sunday DESC) = 1"""


def active(columns, value: str) -> str:
    rows = unpivot(columns, "chosen", "companyId, week_end_sunday", "item")
    return on_merged(
        f"SELECT *, {label_case('item')} AS label FROM ({rows}) x WHERE value > 0", {"chosen": selected(value)}
    )


_SCATTER = f"""SELECT companyId, companyName, execution_count, execution_count_wow,
    CASE WHEN execution_count_wow < 0 THEN 'Declining' ELSE 'Growing' END AS status FROM changed
    WHERE week_end_sunday = {SOME_WEEK} AND execution_count_wow IS NOT NULL"""
_EXEC = f"(SELECT companyId, companyName, execution_count AS v FROM merged WHERE week_end_sunday = {SOME_WEEK})"
_KPIS = "execution_count, dau_count, connect_licenses, MARKETING, UTILITY, AUTHENTICATION, signups, other_plans"
_SNAPSHOT = ["execution_count", "execution_count_wow", "connect_licenses", "connect_licenses_wow"]
_HISTORY = ["execution_count", "MARKETING", "kyc_total", "connect_licenses", "gov_validated"]
_LABELS = {"doccheck": "Document Check", "liveness": "Liveness", "facematch": "Facematch"}
_SOURCES = {
    "workflow": "x_workflow",
    "billing": "x_billing",
    "dau": "x_dau",
    "connect": "x_connect",
    "kyc": "x_kyc",
    "hil_gov": "x_hil",
    "marketplace": "x_marketplace",
    "signups": "x_signups",
}
_WINDOWS = " UNION ALL ".join(
    f"SELECT '{name}' AS source, MIN(week_end_sunday) AS first_week, MAX(week_end_sunday) AS last_week FROM {x}"
    for name, x in _SOURCES.items()
)
_TOP = (
    "companyId, companyName, execution_count, MARKETING, UTILITY, AUTHENTICATION, dau_count, connect_licenses, "
    "marketplace_install_total, connect_plan_list"
)
_MAPPED = f"({installs_sql(START)}) i LEFT JOIN {NUMERIC_MAP} m ON m.userId = i.mapping_user_id"


def overview(value: str) -> str:
    return f"""SELECT w.week_end_sunday, {_KPIS}, active_companies FROM weekly w JOIN
        (SELECT week_end_sunday, COUNT(DISTINCT companyId) AS active_companies FROM merged GROUP BY ALL) a
        USING (week_end_sunday) WHERE week_end_sunday = {value}"""


ORACLE = {
    "optional_source": "SELECT o_orderkey, o_orderstatus FROM orders",
    "licences_with_fallback": sql(
        f"""SELECT companyId, week_end_sunday, {big('SUM(connect_licenses)')} AS connect_licenses
            FROM x_connect GROUP BY ALL""",
        EXPORTS,
    ),
    "merged_csv_roundtrip": on_merged("SELECT * FROM merged"),
    "merged_parquet_by_week": on_merged("SELECT * FROM merged"),
    "marketplace_long_roundtrip": sql("SELECT * FROM x_marketplace", EXPORTS),
    "session_billing_weekly": sql(billing_sql(START)),
    "external_companies": sql(f"SELECT id, name, plan FROM {OUTSIDE} o"),
    "signups_weekly": sql(signups_sql(START)),
    "kyc_steps_weekly": sql(kyc_sql(START)),
    "kyc_hil_government_weekly": sql(hil_sql(START)),
    "week_calendar": sql(
        f"""SELECT CAST(unnest(generate_series({week('a')}, {week('(b + 14)')}, INTERVAL 7 DAY)) AS DATE)
            AS week_end_sunday FROM (SELECT MIN(current_period_start) AS a, MAX(current_period_start) AS b
            FROM subscriptions) x"""
    ),
    "connect_items": sql(items_sql(LICENCE_AS_OF)),
    "connect_licenses_weekly": sql(licences_sql(START, LICENCE_AS_OF)),
    "marketplace_installations": sql(installs_sql(EVENTS_START)),
    "workflow_executions_weekly": sql(workflow_sql(START)),
    "daily_active_users_weekly": sql(dau_sql(EVENTS_START)),
    "company_id_forms": """SELECT c_custkey, CASE c_custkey % 7 WHEN 3 THEN NULL WHEN 5 THEN NULL
        WHEN 4 THEN CONCAT('ab', c_custkey) WHEN 6 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS companyId
        FROM customer""",
    "slug_forms": """SELECT page_id, COALESCE(NULLIF(trim(regexp_replace(lower(url), '[^\\p{L}\\p{N}]+', '_', 'g'),
        '_'), ''), 'unknown') AS slug FROM pages""",
    "token_forms": sql(
        """SELECT lower(conversationType) AS token, CASE WHEN conversationType LIKE 'MARKETING%' THEN 'MARKETING'
            WHEN conversationType IN ('UTILITY', 'AUTHENTICATION') THEN conversationType END AS folded, COUNT(*) AS n
            FROM billing_events GROUP BY ALL"""
    ),
    "lenient_numbers": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value ELSE 0 END AS amount FROM events",
    "strict_export": f"""SELECT o_orderkey, {week('o_orderdate')} AS week_end_sunday, o_totalprice AS amount
        FROM orders""",
    "install_companies": sql(
        f"""SELECT i.installation_id, i.mapping_user_id, m.companyId, i.app_name, i.week_end_sunday
            FROM {_MAPPED} WHERE m.companyId IS NOT NULL"""
    ),
    "install_match_counts": sql(
        f"""SELECT COUNT(m.companyId) AS matched, COUNT(*) - COUNT(m.companyId) AS unmatched FROM {_MAPPED}"""
    ),
    "workflow_prepared": on_merged("SELECT * FROM p_workflow"),
    "dau_prepared": on_merged("SELECT * FROM p_dau"),
    "billing_pivot": on_merged("SELECT * FROM p_billing"),
    "connect_wide": on_merged("SELECT * FROM p_connect"),
    "connect_long": on_merged(
        f"""SELECT {KEY}, plan_tier_display_name AS plan, {big('SUM(connect_licenses)')} AS connect_licenses,
            CONCAT('connect_plan_', replace(lower(plan_tier_display_name), '#', '_')) AS connect_col
            FROM x_connect GROUP BY ALL"""
    ),
    "kyc_long": on_merged(
        f"""SELECT {KEY}, lower(stepName) AS stepName, lower(status) AS status,
            CONCAT('kyc_', lower(stepName), '_', lower(status)) AS kyc_col,
            {big('SUM(kyc_steps_count)')} AS kyc_steps_count FROM x_kyc GROUP BY ALL"""
    ),
    "connect_total_only": on_merged("SELECT companyId, week_end_sunday, connect_licenses FROM p_connect"),
    "kyc_wide": on_merged("SELECT * FROM p_kyc"),
    "kyc_clashing_names": sql(
        f"""SELECT companyId, week_end_sunday, {total("NOT ab", "kyc_steps_count")} AS kyc_a_total,
            {total("ab", "kyc_steps_count")} AS kyc_a_b_total, {total("NOT ab AND s = 'total'", "kyc_steps_count")} AS kyc_a_total_status,
            {total("NOT ab AND s = 'b total' OR ab AND s = 'total'", "kyc_steps_count")} AS kyc_a_b_total_status,
            {total("NOT ab AND s = 'x'", "kyc_steps_count")} AS kyc_a_x, {total("ab AND s = 'x'", "kyc_steps_count")} AS kyc_a_b_x,
            {total("ab AND s = 'b total'", "kyc_steps_count")} AS kyc_a_b_b_total, CAST(0 AS BIGINT) AS kyc_document_check_total,
            CAST(0 AS BIGINT) AS kyc_liveness_total, CAST(0 AS BIGINT) AS kyc_facematch_total,
            {big('SUM(kyc_steps_count)')} AS kyc_total FROM (SELECT {KEY}, stepName = 'liveness' AS ab,
                CASE status WHEN 'Approved' THEN 'b total' WHEN 'Fraud' THEN 'total' ELSE 'x' END AS s, kyc_steps_count FROM x_kyc) c
            GROUP BY companyId, week_end_sunday""",
        EXPORTS,
    ),
    "hil_gov_prepared": on_merged("SELECT * FROM p_hil"),
    "marketplace_long": sql("SELECT * FROM x_marketplace", EXPORTS),
    "marketplace_wide": on_merged("SELECT * FROM p_marketplace"),
    "signups_prepared": on_merged("SELECT * FROM p_signups"),
    "merged_weekly": on_merged("SELECT * FROM merged"),
    "merged_previous_sunday": on_merged(
        """SELECT companyId, week_end_sunday, connect_licenses, dau_count FROM merged
            WHERE week_end_sunday <= DATE '2024-01-28'"""
    ),
    "grain_duplicates": sql(
        f"""SELECT {big('SUM(n - 1)')} AS duplicate_rows FROM
            (SELECT COUNT(*) AS n FROM x_connect GROUP BY companyId, week_end_sunday) g""",
        EXPORTS,
    ),
    "export_grain": sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS source, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
                FROM (SELECT COUNT(*) AS n FROM {x} GROUP BY {', '.join(CONTRACTS[name].grain)}) g"""
            for name, x in _SOURCES.items()
        ),
        EXPORTS,
    ),
    "date_windows": sql(_WINDOWS, EXPORTS),
    "window_mismatch": sql(
        f"""SELECT COUNT(DISTINCT first_week) AS starts, COUNT(DISTINCT last_week) AS ends,
            COUNT(DISTINCT first_week) > 1 OR COUNT(DISTINCT last_week) > 1 AS mismatch FROM ({_WINDOWS}) w""",
        EXPORTS,
    ),
    "merge_summary": on_merged(
        f"""SELECT COUNT(*) AS row_count, {len(METRICS) + len(SIGNUPS) + 4} AS column_count,
            COUNT(DISTINCT companyId) AS companies, COUNT(DISTINCT week_end_sunday) AS weeks,
            MAX(week_end_sunday) AS latest_week FROM merged"""
    ),
    "weekly_totals": on_merged("SELECT * FROM weekly", WEEKLY),
    "weekly_companies": on_merged("SELECT companyId, week_end_sunday, connect_plan_list FROM merged"),
    "monthly_companies": on_merged(
        f"""SELECT companyId, month_start, MIN_BY(companyName, week_end_sunday) AS companyName,
            {", ".join(f"{big(f'SUM({m})')} AS {m}" for m in METRICS)},
            COALESCE((SELECT string_agg(DISTINCT plan, ', ' ORDER BY plan) FROM
                (SELECT unnest(string_split(string_agg(m.connect_plan_list, ', '), ', ')) AS plan) p
                WHERE plan <> ''), '') AS connect_plan_list
            FROM (SELECT *, CAST(date_trunc('month', week_end_sunday) AS DATE) AS month_start FROM merged) m
            GROUP BY companyId, month_start"""
    ),
    "monthly_totals": on_merged("SELECT * FROM monthly", MONTHLY),
    "plan_list_union": on_merged(
        """SELECT companyId, string_agg(DISTINCT plan, ', ' ORDER BY plan) AS plans FROM
            (SELECT companyId, unnest(string_split(connect_plan_list, ', ')) AS plan FROM merged
             WHERE connect_plan_list <> '') p GROUP BY companyId"""
    ),
    "period_change": on_merged(f"SELECT companyId, week_end_sunday, {CHANGES} FROM changed", CHANGED),
    "period_change_monthly": on_merged(
        f"""SELECT companyId, month_start, {", ".join(f"{m}, {change(m, 'month_start')} AS {m}_wow"
            for m in CHANGE_METRICS)} FROM (SELECT companyId,
            CAST(date_trunc('month', week_end_sunday) AS DATE) AS month_start,
            {", ".join(f"{big(f'SUM({m})')} AS {m}" for m in CHANGE_METRICS)} FROM merged GROUP BY ALL) m"""
    ),
    "total_change": on_merged(
        f"SELECT week_end_sunday, signups, {change('signups', by='')} AS wow_change FROM weekly", WEEKLY
    ),
    "available_periods": on_merged("SELECT DISTINCT month_start FROM monthly", MONTHLY),
    "overview_row": on_merged(overview(SOME_WEEK), WEEKLY),
    "overview_latest": on_merged(overview("(SELECT MAX(week_end_sunday) FROM merged)"), WEEKLY),
    "metric_series": on_merged(
        f"""SELECT month_start, series, value, {label_case('series')} AS label FROM ({unpivot(
            ['MARKETING', 'UTILITY', 'AUTHENTICATION', *PLAN_COLUMNS, *KYC_TOTALS, *APPS], 'monthly', 'month_start',
            'series')}) s
            QUALIFY series NOT LIKE 'marketplace_app_%' OR SUM(value) OVER (PARTITION BY series) > 0""",
        MONTHLY,
    ),
    "company_series": on_merged(
        f"""SELECT companyId, week_end_sunday, series, value, {label_case('series')} AS label FROM ({unpivot(
            APPS, 'merged', 'companyId, week_end_sunday', 'series')}) s
            QUALIFY SUM(value) OVER (PARTITION BY companyId, series) > 0"""
    ),
    "series_label_forms": sql(
        f"""SELECT name, CASE name {' '.join(f"WHEN '{n}' THEN '{label}'" for names, label in APPS.values()
            for n in names)} ELSE replace(replace(name, 'NATION', 'Nation'), '_', ' ') END AS label FROM apps"""
    ),
    "top_companies": on_merged(
        f"""SELECT {_TOP} FROM merged WHERE week_end_sunday = {SOME_WEEK}
            ORDER BY execution_count DESC, {TIE} LIMIT 10"""
    ),
    "company_directory": on_merged(
        "SELECT companyId, MIN_BY(companyName, week_end_sunday) AS companyName FROM merged GROUP BY companyId"
    ),
    "company_history": on_merged(
        f"""SELECT week_end_sunday, {", ".join(f"{m}, ROUND_EVEN({m}_wow, 2) AS {m}_wow" for m in _HISTORY)},
            connect_plan_list FROM changed WHERE companyId = '7'""",
        CHANGED,
    ),
    "company_snapshot": on_merged(
        f"""SELECT l.companyId, l.week_end_sunday AS latest_period,
            {", ".join(f"l.{c} AS latest_{c}" for c in _SNAPSHOT)},
            COALESCE(s.week_end_sunday, l.week_end_sunday) AS selected_period,
            {", ".join(f"CASE WHEN s.companyId IS NULL THEN l.{c} ELSE s.{c} END AS selected_{c}" for c in _SNAPSHOT)}
            FROM (SELECT * FROM changed QUALIFY ROW_NUMBER() OVER (PARTITION BY companyId
                ORDER BY week_end_sunday DESC) = 1) l
            LEFT JOIN (SELECT * FROM changed WHERE week_end_sunday = {SOME_WEEK}) s ON s.companyId = l.companyId""",
        CHANGED,
    ),
    "active_items": active(APPS, APP_WEEK),
    "active_plans": active(PLAN_COLUMNS, SOME_WEEK),
    "kyc_status_detail": active(KYC_STATUS, SOME_WEEK),
    "gov_hil_rates": on_merged(
        f"""SELECT companyId, week_end_sunday, {', '.join(HIL_GOV)}, gov_total_queries, hil_total_steps,
            gov_validation_rate_pct, hil_derivation_pct,
            {', '.join(f'hil_{s}_{r}_rate_pct' for s in HIL for r in ('approval', 'disapproval'))} FROM rates""",
        RATES,
    ),
    "gov_hil_delta": on_merged(
        f"""SELECT companyId, week_end_sunday, {", ".join(
            f"{m}, {m} - LAG({m}) OVER (PARTITION BY companyId ORDER BY week_end_sunday) AS {m}_delta"
            for m in ('gov_validation_rate_pct', 'hil_derivation_pct', 'hil_total_steps'))} FROM rates""",
        RATES,
    ),
    "hil_breakdown": on_merged(
        " UNION ALL ".join(
            f"""SELECT companyId, week_end_sunday, '{label}' AS step, hil_{s}_total AS hil_total,
                hil_{s}_approved AS approved, hil_{s}_disapproved AS disapproved,
                ROUND_EVEN(hil_{s}_approval_rate_pct, 2) AS approval_pct,
                ROUND_EVEN(hil_{s}_disapproval_rate_pct, 2) AS disapproval_pct FROM chosen_rates"""
            for s, label in _LABELS.items()
        ),
        RATES,
        {"chosen_rates": selected(SOME_WEEK).replace("FROM merged", "FROM rates")},
    ),
    "distribution_histogram": on_merged(
        f"""SELECT bin, CAST(CASE WHEN bin > 50 THEN 300.0 WHEN bin > 0 THEN (bin - 1) * 6.0 END AS DOUBLE) AS bin_start,
            CAST(CASE WHEN bin < 1 THEN 0.0 WHEN bin <= 50 THEN bin * 6.0 END AS DOUBLE) AS bin_end,
            COUNT(*) AS companies
            FROM (SELECT CAST(CASE WHEN v > 300 THEN 51 ELSE LEAST(50, FLOOR(v / 6.0) + 1) END AS INTEGER) AS bin
            FROM {_EXEC} e) b GROUP BY bin"""
    ),
    "distribution_box": on_merged(
        f"""SELECT q1, median, q3, MIN(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
            AS lower_whisker, MAX(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS upper_whisker,
            COUNT(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
            MIN(v) AS min, MAX(v) AS max
            FROM (SELECT v, quantile_cont(v, 0.25) OVER () AS q1, quantile_cont(v, 0.5) OVER () AS median,
            quantile_cont(v, 0.75) OVER () AS q3 FROM {_EXEC} e) x GROUP BY q1, median, q3"""
    ),
    "distribution_stats": on_merged(
        f"""SELECT COUNT(*) AS companies, ROUND(AVG(v), 6) AS mean, ROUND(quantile_cont(v, 0.5), 6) AS median,
            ROUND(stddev_samp(v), 6) AS std, MIN(v) AS min, MAX(v) AS max FROM {_EXEC} e"""
    ),
    "power_users": on_merged(
        f"""SELECT companyId, companyName, v AS execution_count FROM {_EXEC} e WHERE v > 200
            ORDER BY v DESC, {TIE} LIMIT 10"""
    ),
    "normal_top": on_merged(
        f"""SELECT companyId, companyName, v AS execution_count FROM {_EXEC} e WHERE v <= 200
            ORDER BY v DESC, {TIE} LIMIT 15"""
    ),
    "change_scatter": on_merged(_SCATTER, CHANGED),
    "big_decliners": on_merged(
        f"""SELECT companyId, companyName, execution_count, ROUND_EVEN(execution_count_wow, 2) AS execution_count_wow
            FROM ({_SCATTER}) s WHERE execution_count_wow < 0 AND execution_count >
            (SELECT quantile_cont(execution_count, 0.5) FROM ({_SCATTER}) t)
            ORDER BY s.execution_count_wow, {TIE} LIMIT 15""",
        CHANGED,
    ),
    "top_gainers": on_merged(
        f"""SELECT companyId, companyName, "MARKETING", ROUND_EVEN(MARKETING_wow, 2) AS "MARKETING_wow" FROM changed c
            WHERE week_end_sunday = {SOME_WEEK} ORDER BY c.MARKETING_wow DESC NULLS LAST, {TIE} LIMIT 10""",
        CHANGED,
    ),
    "top_decliners": on_merged(
        f"""SELECT companyId, companyName, "MARKETING", ROUND_EVEN(MARKETING_wow, 2) AS "MARKETING_wow" FROM changed c
            WHERE week_end_sunday = {SOME_WEEK} ORDER BY c.MARKETING_wow ASC NULLS LAST, {TIE} LIMIT 10""",
        CHANGED,
    ),
    "kyc_sessions_monthly": sql(
        f"""SELECT {month('createdAt')} AS month, status, COUNT(*) AS sessions FROM biometrics
            WHERE createdAt >= '{START}' GROUP BY ALL"""
    ),
    "kyc_steps_monthly": sql(
        f"""SELECT {month('createdAt')} AS month, stepName, status, COUNT(*) AS steps FROM biometric_steps
            WHERE createdAt >= '{START}' GROUP BY ALL"""
    ),
    "gov_validation_monthly": sql(
        f"""SELECT {month('bs.createdAt')} AS month, dcs.entityResponse, COUNT(*) AS checks FROM biometric_steps bs
            JOIN document_check_steps dcs ON dcs.id = bs.documentCheckId
            WHERE bs.createdAt >= '{START}' AND bs.stepName = 'document_check' GROUP BY ALL"""
    ),
    "signatures_monthly": sql(
        f"""SELECT {month('createdAt')} AS month, provider, status, COUNT(*) AS signatures FROM signatures
            WHERE createdAt >= '{START}' GROUP BY ALL"""
    ),
    "kyc_volume_by_company": sql(
        f"""SELECT companyId, {month('createdAt')} AS month, COUNT(*) AS sessions FROM biometrics
            WHERE companyId IS NOT NULL GROUP BY ALL"""
    ),
    "kyc_approval_rate": sql(
        f"""SELECT {month('createdAt')} AS month, COUNT(*) AS sessions, {total("status = 'Approved'")} AS approved,
            CAST({total("status = 'Approved'")} AS DOUBLE) / COUNT(*) AS approval_rate FROM biometrics GROUP BY ALL"""
    ),
    "kyc_funnel": sql(
        f"""SELECT 'session' AS stage, COUNT(*) AS sessions, {total("status = 'Approved'")} AS approved FROM biometrics
            UNION ALL SELECT 'not_completed', {total("status IN ('Initiated', 'Incomplete', 'Abandoned')")},
            CAST(0 AS BIGINT) FROM biometrics
            UNION ALL SELECT s.stepName, COUNT(DISTINCT s.biometricId),
            COUNT(DISTINCT CASE WHEN s.status = 'Approved' THEN s.biometricId END)
            FROM biometric_steps s JOIN biometrics b ON b.id = s.biometricId
            WHERE s.stepName IN ({STAGE_LIST}) GROUP BY s.stepName"""
    ),
    "liveness_fraud_rate": sql(
        f"""SELECT {month('createdAt')} AS month, COUNT(*) AS liveness_steps,
            {total("status = 'Fraud' OR lower(description) LIKE '%fraude%'")} AS fraud_steps,
            CAST({total("status = 'Fraud' OR lower(description) LIKE '%fraude%'")} AS DOUBLE) / COUNT(*) AS fraud_rate
            FROM biometric_steps WHERE stepName = 'liveness' GROUP BY ALL"""
    ),
    "facematch_scores": sql(
        f"""SELECT {month('bs.createdAt')} AS month, COUNT(*) AS matches,
            CAST(SUM(similarity) AS DOUBLE) / COUNT(*) AS mean_similarity, quantile_cont(similarity, 0.25) AS q1,
            quantile_cont(similarity, 0.5) AS median, quantile_cont(similarity, 0.75) AS q3
            FROM biometric_steps bs JOIN facematch_steps f ON f.id = bs.facematchId GROUP BY ALL"""
    ),
    "identity_countries": sql(
        """SELECT country, nationality, COUNT(*) AS documents, COUNT(DISTINCT clientId) AS clients
            FROM document_identities GROUP BY ALL"""
    ),
    "security_events_summary": sql(
        f"""SELECT type, severity, COUNT(*) AS events, {total('resolved = 0')} AS unresolved
            FROM security_events GROUP BY ALL"""
    ),
    "steps_enriched": sql(
        """SELECT s.biometricId, s.stepName, s.status, s.createdAt, b.companyId AS session_companyId,
            b.status AS session_status, d.entityResponse AS document_check_entityResponse, i.country AS identity_country,
            l.otpCode AS liveness_otpCode, f.similarity AS facematch_similarity
            FROM biometric_steps s LEFT JOIN biometrics b ON b.id = s.biometricId
            LEFT JOIN document_check_steps d ON d.id = s.documentCheckId
            LEFT JOIN document_identities i ON i.id = d.documentIdentityId
            LEFT JOIN liveness_steps l ON l.id = s.livenessId
            LEFT JOIN facematch_steps f ON f.id = s.facematchId"""
    ),
    "kyc_workflow_context": sql(
        """SELECT b.id, b.companyId, b.status, b.createdAt, json_extract_string(b.details, '$.skill_id') AS skill_id,
            json_extract_string(b.details, '$.execution_id') AS execution_id, e.flow, e.state
            FROM biometrics b LEFT JOIN executions e
              ON e.executionId = json_extract_string(b.details, '$.execution_id')"""
    ),
}
