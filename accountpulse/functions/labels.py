"""Display labels of the dynamic metric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Words of app names that are not simply capitalised.
APP_WORDS = {
    "api": "API",
    "crm": "CRM",
    "kyc": "KYC",
    "mcp": "MCP",
    "pro": "PRO",
    "sap": "SAP",
    "s": "S",
    "4hana": "4HANA",
}
# Brand spellings applied to the finished label.
APP_BRANDS = {
    "Hubspot": "HubSpot",
    "Woocommerce": "WooCommerce",
    "Wordpress.Com": "WordPress.com",
    "Mercadopago": "Mercado Pago",
    "Elevenlabs": "ElevenLabs",
}
# ----------------------------------------------------------------------------

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(text: Column) -> Column:
    """Capital after every non-letter, also after a digit (``4hana`` -> ``4Hana``)."""
    pieces = F.split(text, rf"(?<=[^{_CASED}])(?=[{_CASED}])")
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def _spaced(text: Column) -> Column:
    return F.trim(F.replace(text, F.lit("_"), F.lit(" ")))


def _app_label(text: Column) -> Column:
    words = F.create_map(*[F.lit(x) for pair in APP_WORDS.items() for x in pair])
    named = F.transform(
        F.split(text, "_"),
        lambda w: F.coalesce(F.try_element_at(words, F.lower(w)), title_case(w)),
    )
    label = F.array_join(named, " ")
    for plain, brand in APP_BRANDS.items():
        label = F.replace(label, F.lit(plain), F.lit(brand))
    return label


def series_label(col: Column, family: str) -> Column:
    """Label of a metric column name; ``family`` is plan, app, stage, status or plain."""
    if family == "plan":
        return title_case(_spaced(F.regexp_replace(col, "^connect_plan_", "")))
    if family == "app":
        return _app_label(F.regexp_replace(col, "^marketplace_app_", ""))
    if family == "stage":
        return title_case(_spaced(F.regexp_replace(F.regexp_replace(col, "^kyc_", ""), "_total$", "")))
    if family == "status":
        return title_case(_spaced(F.replace(col, F.lit("kyc_"), F.lit(""))))
    if family == "plain":
        return col
    raise ValueError(f"Unknown label family: {family}")
