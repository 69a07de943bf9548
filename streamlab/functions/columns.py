"""Column rules for NULL, zero, rounding, keys and labels. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from streamlab.schemas import SENTIMENTS, TIE


def parse_event_time(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """String -> timestamp under the same name; unreadable text becomes NULL, not an error."""
    parsed = F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))
    return df.withColumn(col, parsed)


def zero_to_null(col: str) -> Column:
    """Feeds send 0 for "no value"."""
    return F.nullif(F.col(col), F.lit(0))


def default_if_absent(col: str, value) -> Column:
    return F.coalesce(F.col(col), value if isinstance(value, Column) else F.lit(value))


def drop_zero_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose listed measures are all above zero (NULL counts as missing)."""
    for c in cols:
        df = df.where(F.col(c) > 0)
    return df


def to_decimal(df: DataFrame, cols: Sequence[str], precision: int = 18, scale: int = 4) -> DataFrame:
    """Fix money columns to a decimal, rounding half up before any database sees them."""
    kind = DecimalType(precision, scale)
    return df.withColumns({c: F.col(c).try_cast(kind) for c in cols})


def round_decimal(col: Column | str, digits: int) -> Column:
    """Round half up on the decimal value of 15 significant digits and at most 10 decimals.

    That many digits hold no binary noise, which a different summation order leaves in the
    last bits, so reruns and other engines agree. NaN and values of 10^28 and more become NULL.
    """
    col = F.col(col) if isinstance(col, str) else col
    exact = F.format_string("%.14e", col.cast("double")).try_cast("decimal(38,10)")
    return F.when(col.isNotNull(), F.round(exact, digits).cast("double"))


def head_chars(col: str, n: int) -> Column:
    """The first ``n`` characters, for models with a fixed input length."""
    return F.substring(F.col(col), 1, n)


def count_words(col: str) -> Column:
    """Space-separated parts of a text, without building an array of them."""
    spaces = F.length(F.col(col)) - F.length(F.replace(F.col(col), F.lit(" "), F.lit("")))
    return spaces + F.lit(1)


def composite_key(*cols: str, sep: str = "|") -> Column:
    """Parts joined by ``sep``; a NULL part is spelled out as None.

    A backslash goes before a separator or backslash within a part, and before a text that
    reads None, so that different parts never make the same key.
    """

    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))
        return F.coalesce(F.when(text == "None", F.lit("\\None")).otherwise(plain), F.lit("None"))

    return F.concat_ws(sep, *[part(c) for c in cols])


def star_count(label: Column | str) -> Column:
    """Leading digit of a label such as "4 stars"."""
    label = F.col(label) if isinstance(label, str) else label
    return F.substring(label, 1, 1).try_cast("int")


def star_label(stars: Column | str) -> Column:
    """1-2 stars negative, 3 neutral, 4-5 positive; NULL stays NULL."""
    stars = F.col(stars) if isinstance(stars, str) else stars
    positive, neutral, negative = SENTIMENTS
    return (
        F.when(stars <= 2, F.lit(negative))
        .when(stars == 3, F.lit(neutral))
        .when(stars > 3, F.lit(positive))
    )


def versus(a: Column | str, b: Column | str, name_a: str, name_b: str, tie: str = TIE) -> Column:
    """Name of the larger side, or the tie label."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.when(a > b, F.lit(name_a)).when(b > a, F.lit(name_b)).otherwise(F.lit(tie))


def pct_change(price: str, reference: str) -> Column:
    """Change against a reference price in percent; NULL when the reference is absent or 0."""
    return F.try_divide((F.col(price) - F.col(reference)) * F.lit(100.0), F.col(reference))
