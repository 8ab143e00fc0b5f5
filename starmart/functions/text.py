"""Title case on letter/non-letter runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(s) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` only splits on spaces ("Rio-grande"); this splits on any
    non-letter, like ``str.title`` ("Rio-Grande", "Nation_0").  The two agree on
    letters whose upper case is one letter; ligatures, sharp s and dotted
    capital I are cased letter by letter here.
    """
    s = F.col(s) if isinstance(s, str) else s
    runs = F.regexp_extract_all(F.lower(s), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cap = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                               F.substring(w, 2, 1 << 30)))
    return F.when(s.isNotNull(), F.array_join(cap, ""))
