"""Safe casts with the pipeline's rules: bad input becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewatch.schemas import NUMERIC

# Plain decimal text accepted by the numeric cast (optional minus, digits,
# optional fraction). \A and \z anchor the whole string, so a trailing newline is rejected.
NUMERIC_TEXT_PATTERN = r"\A-?[0-9]+(\.[0-9]+)?\z"

# Timestamps begin with year, month and day.
DATE_PATTERN = r"\A\s*[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}"

# Boolean spellings accepted after trimming and lower-casing (unique prefixes of
# true/false/yes/no, "on", "of"/"off", and the digits 1/0).
BOOL_TRUE_WORDS = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
BOOL_FALSE_WORDS = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_empty(c) -> Column:
    """NULLIF(x, '')."""
    c = _col(c)
    return F.when(c != F.lit(""), c)


def to_numeric(c, dtype=NUMERIC) -> Column:
    """Text -> decimal when it is plain decimal text; '' / malformed / overflow -> NULL."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMERIC_TEXT_PATTERN), c.try_cast(dtype))


def to_timestamptz(c) -> Column:
    """Text -> timestamp; '' and text that doesn't begin with a whole date -> NULL (so a time of day
    or a bare year is not completed from the clock or the calendar)."""
    text = _col(c).cast("string")
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("timestamp"))


def bad_timestamps(c) -> Column:
    """Aggregate: how many non-empty texts the timestamp cast rejects."""
    return F.count_if(nullif_empty(_col(c).cast("string")).isNotNull() & to_timestamptz(c).isNull())


def bad_numbers(c) -> Column:
    """Aggregate: how many non-empty texts the numeric cast rejects (or can't hold)."""
    return F.count_if(nullif_empty(_col(c).cast("string")).isNotNull() & to_numeric(c).isNull())


def to_bool_pg(c) -> Column:
    """Text -> boolean with the accepted spellings above; '' and anything else -> NULL."""
    s = F.lower(F.trim(_col(c).cast("string")))
    return (F.when(s.isin(*BOOL_TRUE_WORDS), F.lit(True))
             .when(s.isin(*BOOL_FALSE_WORDS), F.lit(False)))


def first_truthy(*cols) -> Column:
    """First argument that is neither NULL nor ''."""
    return F.coalesce(*[nullif_empty(c) for c in cols])
