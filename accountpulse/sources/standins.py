"""Raw schemas derived from the TPC-H-like test tables.

The test folder has none of the account tables, so each is a projection of one that it has.
The texts run unchanged in Spark SQL and in ANSI engines, with the table names filled in.
One key in 97 is NULL, and dates, flags and enumerations are spread over the source columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

STANDINS = {
    "billing_events": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey % 20 END AS companyId,
               o_orderdate AS createdAt,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'MARKETING' WHEN '2-HIGH' THEN 'MARKETING_LITE'
                    WHEN '3-MEDIUM' THEN 'UTILITY' WHEN '5-LOW' THEN 'AUTHENTICATION' ELSE 'SERVICE' END
                   AS conversationType,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS isBillable
        FROM {orders}""",
    "ai_users": """
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id % 20 END AS companyId,
               CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS referenceId,
               ts AS createdAt
        FROM {events}""",
    "workflow_logs": """
        SELECT l_suppkey % 20 AS company_id,
               CONCAT('Company ', CAST(l_suppkey % 20 AS VARCHAR(20))) AS company_name,
               l_shipdate AS createdAt,
               CAST(l_quantity AS BIGINT) AS total
        FROM {lineitem}""",
    "biometrics": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey % 20 END AS companyId,
               CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Initiated' ELSE 'Disapproved' END AS status,
               CONCAT('{{"skill_id": "', CAST(o_custkey % 50 AS VARCHAR(20)), '", "execution_id": "',
                      CAST(o_orderkey * 2 AS VARCHAR(20)), '"}}') AS details,
               o_orderdate AS createdAt
        FROM {orders}""",
    "biometric_steps": """
        SELECT l_orderkey AS biometricId,
               CASE l_linenumber % 4 WHEN 0 THEN 'document_check' WHEN 1 THEN 'liveness'
                    WHEN 2 THEN 'facematch' ELSE 'otp' END AS stepName,
               CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Disapproved' ELSE 'Fraud' END AS status,
               CASE WHEN l_suppkey % 9 = 0 THEN 'Se detecto FRAUDE en video' ELSE 'Verification step' END
                   AS description,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS enableHumanInLoop,
               CASE WHEN l_linenumber % 4 = 0 THEN l_partkey END AS documentCheckId,
               CASE WHEN l_linenumber % 4 = 1 THEN l_suppkey END AS livenessId,
               CASE WHEN l_linenumber % 4 = 2 THEN l_partkey END AS facematchId,
               l_shipdate AS createdAt
        FROM {lineitem}""",
    "document_check_steps": """
        SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 2 END AS entityResponse,
               p_size % 2 AS regulaResponse,
               CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_partkey END AS documentIdentityId
        FROM {part}
        WHERE p_partkey % 11 <> 0""",
    "document_identities": """
        SELECT c_custkey AS id, c_custkey % 40 AS clientId,
               CONCAT('Country ', CAST(c_nationkey AS VARCHAR(20))) AS country, c_mktsegment AS nationality
        FROM {customer}""",
    "facematch_steps": """
        SELECT p_partkey AS id, 50 + p_size AS similarity
        FROM {part}
        WHERE p_partkey % 13 <> 0""",
    "liveness_steps": """
        SELECT s_suppkey AS id, s_name AS otpCode
        FROM {supplier}
        WHERE s_suppkey % 7 <> 0""",
    "signatures": """
        SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'FAD' ELSE 'OTHER' END AS provider,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Rejected' END AS status,
               o_orderdate AS createdAt
        FROM {orders}""",
    "security_events": """
        SELECT event_id AS id, event_type AS type, CASE WHEN value > 100 THEN 'HIGH' ELSE 'LOW' END AS severity,
               CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS resolved
        FROM {events}""",
    "executions": """
        SELECT CAST(o_orderkey AS VARCHAR(20)) AS executionId, o_orderpriority AS flow, o_orderstatus AS state
        FROM {orders}""",
    "subscriptions": """
        SELECT o_orderkey AS id, o_custkey % 20 AS company_id,
               CASE WHEN o_orderstatus = 'P' THEN 'canceled' ELSE 'active' END AS status,
               CAST(o_orderdate AS DATE) AS current_period_start,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS current_period_end,
               CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + 10 END AS cancel_at,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) - 1 END AS canceled_at
        FROM {orders}""",
    "subscription_items": """
        SELECT l_orderkey AS subscription_id, l_partkey AS plan_tier_id,
               CASE WHEN l_linestatus = 'F' THEN 'connect' ELSE 'other' END AS platform_product_id,
               CAST(l_quantity AS INT) % 5 AS quantity
        FROM {lineitem}""",
    "plan_tiers": """
        SELECT p_partkey AS id, p_brand AS name, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END AS display_name
        FROM {part}""",
    "companies": """
        SELECT c.c_custkey AS id, c.c_name AS name, CAST(NULL AS VARCHAR(20)) AS slug,
               CASE WHEN c.c_custkey % 13 = 0 THEN CONCAT('test', CAST(c.c_custkey AS VARCHAR(20)), '@x.org')
                    ELSE '' END AS email,
               CASE c.c_mktsegment WHEN 'BUILDING' THEN 'SELF_SERVICE' WHEN 'MACHINERY' THEN 'ENTERPRISE'
                    WHEN 'HOUSEHOLD' THEN NULL ELSE 'PRO' END AS plan,
               o.first_order AS createdAt
        FROM {customer} c JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM {orders} GROUP BY o_custkey) o
          ON o.o_custkey = c.c_custkey""",
    "company_users": """
        SELECT c_custkey AS companyId,
               CASE WHEN c_custkey % 17 = 0 THEN 'Impersonate@y.org' WHEN c_custkey % 19 = 0 THEN '  '
                    ELSE 'a@b.org' END AS email,
               CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS isRoot,
               CASE WHEN c_custkey % 34 = 0 AND c_custkey % 3 = 0 THEN CAST('2001-01-01' AS DATE) END AS deletedAt
        FROM {customer}""",
    "user_app_installations": """
        SELECT event_id AS id, user_id AS userId,
               CASE WHEN event_type = 'signup' THEN 'organization' ELSE 'USER' END AS userType,
               user_id + 1 AS installedByUserId, CAST(FLOOR(value) AS BIGINT) % 8 AS appId,
               ts AS createdAt, ts AS updatedAt, CASE WHEN event_type = 'error' THEN ts END AS deletedAt
        FROM {events}""",
    "apps": """
        SELECT n_nationkey AS id, CASE n_nationkey WHEN 0 THEN 'HubSpot' WHEN 1 THEN 'Hubspot'
               WHEN 2 THEN 'SAP S/4HANA Cloud' WHEN 3 THEN 'my-mcp-server' ELSE n_name END AS name
        FROM {nation}""",
    "user_company_map": """
        SELECT DISTINCT CAST(user_id AS VARCHAR(20)) AS userId,
               CASE WHEN user_id % 10 = 9 THEN 'n/a' ELSE CAST(user_id % 20 AS VARCHAR(20)) END AS companyId
        FROM {events}""",
}


def tables_of(name: str) -> list[str]:
    """Test tables that a stand-in reads."""
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", STANDINS[name])))


def standin(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return standins(spark, folder, [name])[name]


def standins(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Several stand-ins; a table that many of them read is opened once."""
    names = list(names)
    opened = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in {t for n in names for t in tables_of(n)}}
    found = {n: spark.sql(STANDINS[n], **{t: opened[t] for t in tables_of(n)}) for n in names}
    if "workflow_logs" in found:
        # The real collection nests the company in one document.
        found["workflow_logs"] = found["workflow_logs"].selectExpr(
            "named_struct('id', company_id, 'name', company_name) AS company", "createdAt", "total"
        )
    return found


def standin_sql(name: str) -> str:
    """The same text for an engine that has the test tables as views."""
    return STANDINS[name].format(**{t: t for t in tables_of(name)})
