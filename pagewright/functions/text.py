"""Text normalisation shared by the operators."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The White_Space property plus the zero-width marks that print as nothing.
SPACES = r"(?U)[\s\x1c-\x1f᠎​‌‍⁠﻿]+"
# Abbreviations for "none" in English and French, compared after folding.
NONE_WORDS = ("na", "n/a", "n/a.", "n.a", "n.a.", "nd", "n/d", "n.d.", "nil", "none", "null", "s/o", "s.o.", "so", "tbd", "tba")


@F.pandas_udf(T.StringType())
def _fold_unicode(values: pd.Series) -> pd.Series:
    def fold(v):
        return None if v is None else unicodedata.normalize("NFC", unicodedata.normalize("NFD", v).casefold())

    return values.map(fold, na_action="ignore").astype(object).where(values.notna(), None)


def folded(*cols: str) -> list[Column]:
    """Columns without white space, case and composition differences.

    Plain ASCII stays in the JVM; one Arrow column carries only the rows with other characters.
    """
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x1e")) for c in cols])
    plain = joined.rlike(r"\A[\x00-\x7f]*\z")
    whole = F.when(plain, F.lower(joined)).otherwise(_fold_unicode(F.when(~plain, joined)))
    parts = F.split(whole, "\x1f")
    return [F.regexp_replace(parts[i], SPACES, "") for i in range(len(cols))]


def blank_to_null(c: Column) -> Column:
    """Null for nothing, a mere sign, or an abbreviation for none."""
    return F.when(c.rlike(r"[\p{L}\p{N}]") & ~c.isin(*NONE_WORDS), c)
