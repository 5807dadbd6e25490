"""Customer id normalisation across documents that name the id differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values from the reference: id field aliases, in fallback order.
ACTIVITY_ID_ALIASES = ["customer_id", "customerId", "customerID", "user_id", "userId", "userID"]
SURVEY_ID_ALIASES = ["customer_id", "customerId", "customerID", "userId", "userID"]


def coalesce_present(df: DataFrame, names) -> Column:
    """First non-null among the alias columns the frame actually has (NULL if none).

    An alias that differs from another only by case is looked up under its
    distinct column name (``customerID`` → ``customerID_``).
    """
    from cohortium.sources.tables import column_name

    present = []
    for n in names:
        for cand in (column_name(n), n):
            if cand in df.columns:
                present.append(F.col(cand).cast("string"))
                break
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def to_customer_id(c: Column) -> Column:
    """Integral id of a text or number: junk → NULL, '12', '12.0', '1.2e1' and 12 agree.

    Digits are read as a 64-bit integer, exactly. Only other spellings go through
    DOUBLE, and only up to 2^53, where every integer is still exact.
    """
    num = c.try_cast("double")
    exact = (num == F.floor(num)) & (F.abs(num) <= F.lit(float(1 << 53)))
    return F.coalesce(c.try_cast("long"), F.when(exact, num.cast("long")))


def normalized_customer_id(df: DataFrame, aliases=ACTIVITY_ID_ALIASES) -> Column:
    return to_customer_id(coalesce_present(df, aliases))
