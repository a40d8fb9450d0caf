"""Cleaning of scalar values, all as Column expressions that stay in generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake(name: str) -> str:
    """A header in snake case: runs of other characters become one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip()).lower()).strip("_")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Columns in snake case; unnamed ones and later ones of the same name go."""
    seen, out = set(), []
    for c in df.columns:
        s = snake(c)
        if s and not s.startswith("unnamed") and s not in seen:
            seen.add(s)
            out.append(F.col(f"`{c}`").alias(s))
    return df.select(out)


def coerce(c: Column, kind: str) -> Column:
    """Text to a type; what doesn't fit is null. Integers go through double, so ``1.5`` is 1; decimals are doubles."""
    text = F.trim(c.cast("string"))
    text = F.when(text != "", text)
    kind = kind.upper()
    if kind in ("INT64", "INTEGER", "INT"):
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    if kind in ("FLOAT64", "FLOAT", "NUMERIC", "BIGNUMERIC", "DECIMAL"):
        return text.try_cast("double")
    if kind in ("BOOLEAN", "BOOL"):
        return F.when(F.lower(text).isin("true", "1", "yes", "y", "t"), True).when(F.lower(text).isin("false", "0", "no", "n", "f"), False)
    if kind == "DATE":
        return F.to_date(parse_timestamp(c))
    if kind == "TIMESTAMP":
        return parse_timestamp(c)
    return text


def parse_timestamp(c: Column) -> Column:
    """ISO text with or without offset, a date, or seconds since the epoch; zero dates are null."""
    text = F.trim(c.cast("string"))
    zero = text.startswith("0000-00-00")
    epoch = F.when(text.rlike(r"^\d{9,11}(\.\d+)?$"), F.timestamp_seconds(text.try_cast("double")))
    return F.when(~zero, F.coalesce(epoch, F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def phone(c: Column) -> Column:
    """Ten digits, a leading 1 of eleven dropped; null for other lengths, one digit over and over, and 555-01xx."""
    digits = F.regexp_replace(c, r"\D", "")
    digits = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return F.when((F.length(digits) == 10) & ~digits.rlike(r"^(\d)\1{9}$") & ~digits.rlike(r"^\d{3}55501\d\d$"), digits)


def email(c: Column, plain: tuple[str, ...] = ("gmail.com", "googlemail.com")) -> Column:
    """Lower case, and on listed domains without plus tag and dots; null unless there is one @ with text around it."""
    text = F.lower(F.trim(c))
    local, domain = F.regexp_extract(text, r"^([^@\s]+)@([^@\s]+)$", 1), F.regexp_extract(text, r"^([^@\s]+)@([^@\s]+)$", 2)
    local = F.when(domain.isin(*plain), F.replace(F.regexp_replace(local, r"\+.*$", ""), F.lit("."), F.lit(""))).otherwise(local)
    return F.when((local != "") & (domain != ""), F.concat(local, F.lit("@"), domain))


def address_key(*parts: Column) -> Column:
    """SHA-256 of the parts in upper case, white space in runs made one, null as empty."""
    return F.sha2(F.concat_ws("|", *(F.regexp_replace(F.upper(F.trim(F.coalesce(p, F.lit("")))), r"\s+", " ") for p in parts)), 256)


def device_hash(*signals: Column) -> Column:
    """SHA-256 of device signals, null as empty, a bar between them."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(s.cast("string"), F.lit("")) for s in signals)), 256)


def strip_tags(c: Column) -> Column:
    """Text without tags, the five basic entities decoded, white space in runs made one."""
    text = F.regexp_replace(c, r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def yes_no(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.when(text.isin("yes", "y", "true", "1"), "Yes").when(text.isin("no", "n", "false", "0"), "No")


def scan_cost(n_bytes: Column, price_per_tib: float) -> Column:
    return F.round(n_bytes / (1 << 40) * price_per_tib, 6)


def day_folder(path: Column) -> Column:
    """The date in a path that has .../yyyy/mm/dd/... or yyyy-mm-dd or yyyymmdd in it."""
    digits = F.regexp_extract(path, r"(\d{4})[-/]?(\d{2})[-/]?(\d{2})", 0)
    return F.when(digits != "", F.coalesce(F.try_to_date(F.regexp_replace(digits, r"\D", ""), "yyyyMMdd")))
