from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from accountpulse.functions import weeks
from accountpulse.functions.labels import series_label
from accountpulse.functions.numbers import parsed_or_zero, pct_change, rate_pct
from accountpulse.functions.text import (
    clean_token,
    company_order,
    fold_conversation_type,
    is_external,
    normalize_company_id,
    slug,
)

INF = float("inf")


def mapped(frame, values, expression, ddl="x STRING"):
    df = frame(f"i INT, {ddl}", [(i, v) for i, v in enumerate(values)])
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_week_end_sunday_bounds(frame):
    stamps = [
        datetime(2025, 1, 1, 12),
        datetime(2025, 1, 5, 23, 59, 59),
        datetime(2025, 1, 6, 0, 0, 0),
        datetime(2025, 1, 12, 0, 0, 0),
    ]
    got = mapped(frame, stamps, weeks.week_end_sunday, "x TIMESTAMP_NTZ")
    assert got == [date(2025, 1, 5), date(2025, 1, 5), date(2025, 1, 12), date(2025, 1, 12)]


def test_month_is_that_of_the_sunday(frame):
    got = mapped(frame, [date(2025, 2, 2)], weeks.month_start, "x DATE")
    assert got == [date(2025, 2, 1)]


@pytest.mark.parametrize(
    "as_of, include, expected",
    [
        (date(2026, 3, 5), True, date(2026, 3, 1)),
        (date(2026, 4, 5), True, date(2026, 4, 5)),
        (date(2026, 4, 5), False, date(2026, 3, 29)),
        (date(2026, 3, 5), False, date(2026, 3, 1)),
    ],
)
def test_last_closed_sunday(as_of, include, expected):
    assert weeks.last_closed_sunday(as_of, include) == expected


def test_calendar_bounds():
    assert weeks.calendar_bounds(date(2025, 1, 1), date(2025, 1, 10)) == (date(2025, 1, 5), date(2025, 1, 26))
    assert weeks.calendar_bounds(date(2025, 1, 1), date(2024, 1, 1)) == (date(2025, 1, 5), date(2025, 1, 5))
    assert weeks.calendar_bounds(date(2025, 1, 1), date(2025, 1, 12))[1] == date(2025, 1, 26)


def test_company_id_forms(frame):
    values = [" 12 ", "12.0", "", "nan", "None", "ab1", None, "007", "12.5", "1d", "1e3", "-3", "9" * 40, "+5", "  "]
    expected = ["12", "12", None, None, None, "ab1", None, "7", "12", "1d", "1000", "-3", "9" * 40, "5", None]
    assert mapped(frame, values, normalize_company_id) == expected


def test_company_order_is_numeric_then_text(frame):
    df = frame("companyId STRING", [("10",), ("9",), ("b",), ("a",), (None,)])
    assert [r[0] for r in df.orderBy(*company_order()).collect()] == ["9", "10", "a", "b", None]


def test_tokens_and_types(frame):
    assert mapped(frame, [" Approved ", "NaN", "None", "", None], clean_token) == ["approved", None, None, None, None]
    types = [" marketing_lite", "Utility", "SERVICE", None, "AUTHENTICATION"]
    assert mapped(frame, types, fold_conversation_type) == ["MARKETING", "UTILITY", None, None, "AUTHENTICATION"]


def test_slug(frame):
    values = ["SAP S/4HANA", "  Pro -- Plan ", "---", "", "Básico Ñ", None]
    expected = ["sap_s_4hana", "pro_plan", "unknown_plan", "unknown_plan", "básico_ñ", "unknown_plan"]
    assert mapped(frame, values, lambda c: slug(c, "unknown_plan")) == expected


def test_external_text(frame):
    values = [None, "", "My TEST shop", "Shop", "Prueba"]
    got = mapped(frame, values, lambda c: is_external(c, ("test", "prueba")))
    assert got == [True, True, False, True, False]


def test_pct_change(frame):
    df = frame("i INT, cur INT, prev INT", [(0, 5, 0), (1, 0, 0), (2, 0, 5), (3, 5, None), (4, 6, 4), (5, -1, 0)])
    got = [r[0] for r in df.orderBy("i").select(pct_change(F.col("cur"), F.col("prev"))).collect()]
    assert got == [INF, None, -100.0, None, 50.0, -INF]


def test_rate_is_zero_without_denominator(frame):
    df = frame("i INT, a INT, b INT", [(0, 1, 4), (1, 1, 0), (2, 1, None)])
    assert [r[0] for r in df.orderBy("i").select(rate_pct(F.col("a"), F.col("b"))).collect()] == [25.0, 0.0, 0.0]


def test_lenient_numbers(frame):
    df = frame("i INT, x STRING", [(0, " 5 "), (1, "x"), (2, None), (3, "1d"), (4, "2.5"), (5, "1e2"), (6, "NaN")])
    got = [r[0] for r in df.orderBy("i").select(parsed_or_zero(df, "x")).collect()]
    assert got == [5.0, 0.0, 0.0, 0.0, 2.5, 100.0, 0.0]
    floats = frame("x DOUBLE", [(float("nan"),)])
    assert floats.select(parsed_or_zero(floats, "x")).first()[0] == 0.0


@pytest.mark.parametrize(
    "family, column, label",
    [
        ("plan", "connect_plan_pro_2x_team", "Pro 2X Team"),
        ("app", "marketplace_app_sap_s_4hana_cloud", "SAP S 4HANA Cloud"),
        ("app", "marketplace_app_hubspot_crm", "HubSpot CRM"),
        ("app", "marketplace_app_mercadopago", "Mercado Pago"),
        ("app", "marketplace_app_my_mcp_server", "My MCP Server"),
        ("stage", "kyc_document_check_total", "Document Check"),
        ("status", "kyc_liveness_approved", "Liveness Approved"),
        ("plain", "MARKETING", "MARKETING"),
    ],
)
def test_labels(frame, family, column, label):
    assert mapped(frame, [column], lambda c: series_label(c, family)) == [label]
