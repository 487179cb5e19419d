"""Date functions (H9-H11, P6 parsing). ANSI mode stays on: parse with try_*."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FDA_FORMAT = "yyyyMMdd"
ISO_DATE_FORMAT = "yyyy-MM-dd"

# Source formats unified by H9: compact dates, ISO 8601 instants, RFC 822
# dates (weekday removed first; Spark's parser does not take 'EEE').
ISO_INSTANT_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ss"]
RFC822_FORMATS = ["d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm z"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_fda_date(c: Column | str) -> Column:
    """'yyyyMMdd' text -> DATE, null when unparseable (never throws)."""
    return F.try_to_date(_col(c), FDA_FORMAT)


def fda_to_iso(c: Column | str) -> Column:
    """H10: 'yyyyMMdd' -> 'yyyy-MM-dd' (null when unparseable)."""
    return F.date_format(parse_fda_date(c), ISO_DATE_FORMAT)


def iso_to_fda(c: Column | str) -> Column:
    """H10: 'yyyy-MM-dd' -> 'yyyyMMdd' (null when unparseable)."""
    return F.date_format(F.try_to_date(_col(c), ISO_DATE_FORMAT), FDA_FORMAT)


def unify_dates(c: Column | str) -> Column:
    """H9: compact, ISO 8601 or RFC 822 text -> TIMESTAMP (UTC session)."""
    text = F.trim(_col(c))
    no_weekday = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    candidates = [F.try_to_timestamp(text, F.lit(FDA_FORMAT))]
    candidates += [F.try_to_timestamp(text, F.lit(f)) for f in ISO_INSTANT_FORMATS]
    candidates += [F.try_to_timestamp(no_weekday, F.lit(f)) for f in RFC822_FORMATS]
    return F.coalesce(*candidates)


def date_parts(d: Column | str, pad_names: bool = False) -> dict[str, Column]:
    """Calendar attributes of a DATE (English names).

    Names are unpadded by default; ``pad_names`` pads them with blanks to 9
    characters, as PostgreSQL's TO_CHAR 'Month' / 'Day' print them.
    """
    d = _col(d)
    month_name, day_name = F.date_format(d, "MMMM"), F.date_format(d, "EEEE")
    if pad_names:
        month_name, day_name = F.rpad(month_name, 9, " "), F.rpad(day_name, 9, " ")
    return {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": month_name,
        "quarter": F.quarter(d),
        "day_of_week": day_name,
    }
