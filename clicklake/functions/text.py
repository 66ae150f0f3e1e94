"""Report lines as expressions: the text is built where the rows are."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clicklake import schema as S


def segment_line() -> Column:
    return F.concat(F.col("segment"), F.lit(": "), F.col("users").cast("string"))


def product_line() -> Column:
    return F.format_string(S.PRODUCT_LINE, F.coalesce("product_id", F.lit("None")), F.col("view_count"))


def category_label(category: str = "category") -> Column:
    """The category, or the fallback where it is missing or empty."""
    return F.coalesce(F.nullif(F.col(category), F.lit("")), F.lit(S.FALLBACK_CATEGORY))


def conversion_line() -> Column:
    """Percent with two decimals, exact halves to the even digit (``format_string`` alone would round them up)."""
    percent = F.bround(F.col("conversion_rate") * 100, 2)
    return F.format_string(S.CONVERSION_LINE, category_label(), percent, F.col("views"), F.col("purchases"))
