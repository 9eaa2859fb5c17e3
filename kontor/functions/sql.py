"""The scalar functions for SQL: defined in SQL, so the optimiser inlines them and no Python runs.

`register(spark)` makes them temporary functions of the session.  Each says the same as the
Column function of its name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from kontor import fixed_values as V
from kontor.functions.contacts import EMAIL_IN_TEXT
from kontor.functions.text import SPACE

NO_DIGIT = r"[^\p{Nd}]"

# name: (parameters, type, body); later bodies may use earlier functions.
FUNCTIONS = {
    "strip_text": ("text STRING", "STRING", rf"regexp_replace(text, r'(?U)^{SPACE}++|(?<!{SPACE}){SPACE}++\z', '')"),
    "blank_to_null": ("text STRING", "STRING", "nullif(strip_text(text), '')"),
    "register_id": ("text STRING", "STRING", f"nullif(regexp_extract(text, r'{V.REGISTER_ID}', 0), '')"),
    "digits_of": ("text STRING", "STRING", f"regexp_replace(text, r'{NO_DIGIT}', '')"),
    "is_phone": ("text STRING", "BOOLEAN", f"length(digits_of(text)) = {V.PHONE_DIGITS}"),
    "is_email": ("text STRING", "BOOLEAN", rf"text RLIKE r'^{V.EMAIL}\z'"),
    "is_website": ("text STRING", "BOOLEAN", f"lower(text) RLIKE r'{V.WEBSITE_START}'"),
    "normalise_website": (
        "text STRING", "STRING",
        "CASE WHEN startswith(strip_text(lower(text)), 'www.') THEN concat('https://', strip_text(lower(text))) "
        "ELSE strip_text(lower(text)) END",
    ),
    "email_from_link": (
        "href STRING", "STRING",
        f"CASE WHEN is_email(strip_text(replace(href, '{V.MAILTO}', ''))) THEN strip_text(replace(href, '{V.MAILTO}', '')) END",
    ),
    "first_email": (
        "text STRING", "STRING", f"CASE WHEN contains(text, '@') THEN nullif(regexp_extract(text, r'{EMAIL_IN_TEXT}', 0), '') END",
    ),
    "phones_in_text": (
        "text STRING, pattern STRING", "ARRAY<STRING>",
        # A function cannot be called on the variable of a lambda.
        rf"filter(transform(regexp_extract_all(text, concat('(', pattern, ')'), 1), one -> regexp_replace(one, r'{NO_DIGIT}', '')), "
        f"one -> length(one) = {V.PHONE_DIGITS})",
    ),
    "join_list": ("items ARRAY<STRING>", "STRING", "nullif(array_join(items, ','), '')"),
    "registration_date": (
        "phrase STRING", "DATE",
        f"CASE WHEN year(try_to_date(nullif(regexp_extract(phrase, r'{V.REGISTERED_ON}', 1), ''), '{V.REGISTERED_ON_FORMAT}')) "
        f"BETWEEN {V.FIRST_YEAR} AND {V.LAST_YEAR} "
        f"THEN try_to_date(nullif(regexp_extract(phrase, r'{V.REGISTERED_ON}', 1), ''), '{V.REGISTERED_ON_FORMAT}') END",
    ),
    "iso_date": ("day DATE", "STRING", "date_format(day, 'yyyy-MM-dd')"),
    "form_encode": ("text STRING", "STRING", "replace(replace(url_encode(text), '*', '%2A'), '%7E', '~')"),
    "search_url": ("name STRING, base STRING, suffix STRING", "STRING", "concat(base, form_encode(name), suffix)"),
    "resolve_link": (
        "base STRING, href STRING", "STRING",
        r"CASE WHEN href = '' THEN NULL WHEN href RLIKE r'^[A-Za-z][A-Za-z0-9+.-]*:' THEN href "
        r"WHEN startswith(href, '//') THEN concat(regexp_extract(base, r'^([a-z]+:)//', 1), href) "
        r"WHEN href RLIKE r'^[/?#]' THEN concat(base, href) "
        r"ELSE concat(base, '/', regexp_replace(href, r'^(\.{1,2}/)+', '')) END",
    ),
}


def register(spark: SparkSession) -> None:
    """Create or replace all of them in this session."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
