"""Key expressions: business hash, surrogate id, date and month keys, code normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_hash(*parts: Column | str) -> Column:
    """SHA-256 over the trimmed parts joined by ``||``; a NULL part counts as ''."""
    texts = [F.coalesce(F.trim(_col(p).cast("string")), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("||", *texts), 256)


def surrogate_id(code: Column | str) -> Column:
    """Positive 60-bit id, a pure function of the code, so reloads never renumber.

    The dimension load refuses a batch in which two codes share an id.
    """
    return F.conv(F.substring(F.md5(_col(code).cast("string")), 1, 15), 16, 10).cast("bigint")


def normal_code(code: Column | str) -> Column:
    """Text form of a char or int code without padding or leading zeros."""
    return F.regexp_replace(F.trim(_col(code).cast("string")), "^0+(?=.)", "")


def date_key(date: Column | str) -> Column:
    d = _col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(date: Column | str) -> Column:
    d = _col(date)
    return (F.year(d) * 100 + F.month(d)).cast("int")
