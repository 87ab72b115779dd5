"""Column expressions used across the operators; all of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that the default dialect reads as a missing value.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

TWO_TO_32 = 4294967296.0


def clip_sql(value: str, lower: float, upper: float) -> str:
    """The same bound as SQL text, naming a long value once; the value must not be null."""
    return f"greatest({lower}D, least({upper}D, {value}))"


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a number; unlike ``greatest``/``least`` a null stays null."""
    out = F.when(value < F.lit(lower), F.lit(lower)) if lower is not None else None
    if upper is not None:
        high = F.lit(upper)
        out = F.when(value > high, high) if out is None else out.when(value > high, high)
    return value if out is None else out.otherwise(value)


def text_to_double(text: Column) -> Column:
    """Lenient parse: what is no number becomes null (so do NaN and Java's 1d / 1f forms)."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & ~text.rlike(r"[0-9.][dDfF]\s*$"), number)


def floor_week(day: Column) -> Column:
    """Week of a day offset, rounding down: day -3 is in week -1."""
    return F.floor(day / F.lit(7)).cast("int")


def truncated_week(day: Column) -> Column:
    """Week of a day offset by integer division: day -3 is in week 0."""
    return (day / F.lit(7)).cast("int")


def digest(seed: int, *keys: Column) -> Column:
    """32 hexadecimal digits fixed by the keys and the seed."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def digest_uniform(digits: Column, part: int = 0) -> Column:
    """A number in [0, 1) from one of the four 8-digit parts of a digest."""
    return F.conv(F.substring(digits, 1 + 8 * part, 8), 16, 10).cast("double") / F.lit(TWO_TO_32)


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) fixed by the keys and the seed: equal on every rerun and partitioning."""
    return digest_uniform(digest(seed, *keys))


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * F.lit(100.0))


def erfc(x: str) -> Column:
    """Complementary error function of a non-negative column (Spark has none).

    Below 2.5 the all-positive series of erf, above it the continued fraction; both are
    folded from the innermost term outwards and reach double precision.
    """
    series = f"aggregate(sequence(60, 1, -1), 1.0D, (s, n) -> 1 + s * {x} * {x} * 2 / (2 * n + 1))"
    fraction = f"aggregate(sequence(40, 1, -1), {x}, (f, n) -> {x} + n / 2.0D / f)"
    return F.expr(
        f"CASE WHEN {x} < 2.5D THEN 1 - 2 / sqrt(pi()) * {x} * exp(-{x} * {x}) * {series} "
        f"ELSE exp(-{x} * {x}) / (sqrt(pi()) * {fraction}) END"
    )


