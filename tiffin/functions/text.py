"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The places between characters where a run of letters and digits begins.
_WORD_STARTS = r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}])"


def initcap_words(c: Column) -> Column:
    """Capitalise every run of letters and digits: ``new-delhi o'brien`` to ``New-Delhi O'Brien``.

    Spark's own ``initcap`` starts words only after blanks, so the text is cut where words start, each
    piece is capitalised, and the pieces are joined again. Stays in the JVM; NULL gives NULL, '' gives ''.
    """

    def capitalise(piece: Column) -> Column:
        first = F.substring(piece, 1, 1)
        upper = F.upper(first)
        # A letter without a single capital, such as a sharp s, stays as it is.
        start = F.when(F.length(upper) == 1, upper).otherwise(first)
        return F.concat(start, F.lower(F.substring(piece, F.lit(2), F.length(piece))))

    return F.array_join(F.transform(F.split(c, _WORD_STARTS), capitalise), "")
