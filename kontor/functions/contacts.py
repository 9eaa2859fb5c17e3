"""Contact rules: phones, e-mails, websites, and the router between them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import as_col, strip


def register_id(text: Column | str, pattern: str = V.REGISTER_ID) -> Column:
    """The first register id in the text, NULL if there is none."""
    return F.nullif(F.regexp_extract(as_col(text), pattern, 0), F.lit(""))


def digits(text: Column | str) -> Column:
    return F.regexp_replace(as_col(text), r"[^\p{Nd}]", "")


def is_phone(text: Column | str, length: int = V.PHONE_DIGITS) -> Column:
    return F.length(digits(text)) == length


def is_email(text: Column | str) -> Column:
    r"""Whole-text match; `\z` because `$` would let a final newline pass."""
    return as_col(text).rlike(rf"^{V.EMAIL}\z")


def is_website(text: Column | str) -> Column:
    return F.lower(as_col(text)).rlike(V.WEBSITE_START)


def normalise_website(text: Column | str) -> Column:
    url = strip(F.lower(as_col(text)))
    return F.when(url.startswith("www."), F.concat(F.lit("https://"), url)).otherwise(url)


def email_from_link(href: Column | str) -> Column:
    """The address of a `mailto:` link; NULL if it is not a plain valid address."""
    address = strip(F.replace(as_col(href), F.lit(V.MAILTO), F.lit("")))
    return F.when(is_email(address), address)


def first_mailto(hrefs: Column | str) -> Column:
    """The first `mailto:` link of an array; only that one is considered."""
    return F.get(F.filter(as_col(hrefs), lambda href: href.startswith(V.MAILTO)), F.lit(0))


# The same matches as the plain pattern, but tried only where a run of characters
# begins, so that a long run without `@` is passed once and not once per character.
EMAIL_IN_TEXT = rf"(?<!{V.EMAIL_LOCAL}){V.EMAIL_LOCAL}++@{V.EMAIL_DOMAIN}"


def first_email(text: Column | str) -> Column:
    """First e-mail in running text.  The cheap `@` test spares most texts the regex."""
    text = as_col(text)
    return F.when(F.contains(text, F.lit("@")), F.nullif(F.regexp_extract(text, EMAIL_IN_TEXT, 0), F.lit("")))


def phones_in_text(text: Column | str, pattern: str) -> Column:
    """All phones of running text as digits, in text order, repeats kept."""
    found = F.regexp_extract_all(as_col(text), F.lit(f"({pattern})"), F.lit(1))
    return F.transform(F.filter(found, lambda one: is_phone(one)), digits)


def route_blocks(blocks: Column | str, hrefs: Column | str) -> Column:
    """Contact blocks and links of one page as `phone_numbers, email, website`.

    A block is a phone if it holds exactly ten digits, else a website if it starts
    like one; all phones are kept, the last website wins.  The first `mailto:` link
    gives the e-mail.  Without such a link, the first phone block that is an
    e-mail as written (before its digits are taken) is moved to the e-mail.
    """
    blocks = as_col(blocks)
    link = first_mailto(hrefs)
    phone_blocks = F.filter(blocks, lambda block: is_phone(block))
    misfiled = F.when(link.isNull(), F.get(F.filter(phone_blocks, is_email), F.lit(0)))
    at = F.coalesce(F.array_position(phone_blocks, misfiled), F.lit(0))
    kept = F.filter(phone_blocks, lambda _, i: i + 1 != at)
    sites = F.filter(blocks, lambda block: ~is_phone(block) & is_website(block))
    return F.struct(
        F.transform(kept, digits).alias("phone_numbers"),
        F.coalesce(email_from_link(link), misfiled).alias("email"),
        normalise_website(F.try_element_at(sites, F.lit(-1))).alias("website"),
    )
