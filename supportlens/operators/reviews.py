"""App-store reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame

from supportlens.functions.text import commas_to_blanks


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Commas of any script in title and text become blanks."""
    return reviews.withColumns({c: commas_to_blanks(c) for c in ("Review_Title", "Review_Text")})
