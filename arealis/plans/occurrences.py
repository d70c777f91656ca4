"""Raw vehicle occurrence sheets to a typed, categorised, deduplicated table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from arealis.operators import cleaning
from arealis.operators.combine import drop_duplicate_rows
from arealis.operators.schema import drop_present, normalize_names
from arealis.presets import vehicle


def clean_occurrences(raw: DataFrame) -> DataFrame:
    """The whole cleaning. Every step skips columns the sheet does not have.

    The one shuffle is the deduplication. It comes before the derived columns: they follow from the
    others, so the distinct rows are the same, and the shuffle carries half the width.
    """
    named = normalize_names(raw)
    texts = cleaning.blank_tokens(cleaning.trim_text(named))
    kept = cleaning.upper_text(drop_present(texts, vehicle.DROPPED), vehicle.UPPERCASED)
    typed = (
        kept.transform(cleaning.cast_dates, vehicle.DATES)
        .transform(cleaning.cast_timestamps, vehicle.TIMESTAMPS)
        .transform(cleaning.cast_integers, vehicle.INTEGERS)
        .transform(cleaning.cast_clocks, vehicle.CLOCKS)
        .transform(cleaning.cast_coordinates, vehicle.COORDINATES)
    )
    return (
        drop_duplicate_rows(typed)
        .transform(cleaning.add_hour, "hora_ocorrencia", "hora_ocorrencia_num")
        .transform(cleaning.add_categories, vehicle.CATEGORIES)
        .transform(cleaning.add_indicators, vehicle.FLAGS)
    )
