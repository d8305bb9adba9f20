"""Split/bonus adjustment factor from an action's free-text details.

A native expression (regexp_extract + when), so it runs inside whole-stage
codegen and does not block filter pushdown as a Python UDF would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.casts import PY_WHITESPACE

# The two recognised statement patterns. A bonus "n:d" is tried
# first; otherwise a face-value split "RS orig TO RS new". ``(?d)`` makes '.'
# stop only at '\n', as in Python.
BONUS_PATTERN = r"(?d)BONUS.*?(\d+):(\d+)"
SPLIT_PATTERN = rf"RS{PY_WHITESPACE}+([\d.]+){PY_WHITESPACE}+TO{PY_WHITESPACE}+RS{PY_WHITESPACE}+([\d.]+)"

# Actions that can adjust prices are selected by this pattern on
# action_type.
ADJUSTING_ACTION = "(?i)bonus|split"


def adjustment_factor(details: Column | str) -> Column:
    """Price multiplier implied by ``details``.

    * null/empty -> 1.0
    * ``BONUS ... n:d`` -> d / (d + n)  (``0:0`` -> 1.0)
    * ``RS orig TO RS new`` -> new / orig when orig > 0 (malformed numbers -> 1.0)
    * anything else -> 1.0
    """
    d = F.col(details) if isinstance(details, str) else details
    s = F.upper(d)
    bonus = s.rlike(BONUS_PATTERN)
    n = F.regexp_extract(s, BONUS_PATTERN, 1).try_cast("double")
    den = F.regexp_extract(s, BONUS_PATTERN, 2).try_cast("double")
    split = s.rlike(SPLIT_PATTERN)
    orig = F.regexp_extract(s, SPLIT_PATTERN, 1).try_cast("double")
    new = F.regexp_extract(s, SPLIT_PATTERN, 2).try_cast("double")
    bonus_factor = F.coalesce(F.try_divide(den, den + n), F.lit(1.0))
    split_factor = F.when(orig > 0, new / orig)
    return (
        F.when(d.isNull() | (d == ""), F.lit(1.0))
        .when(bonus, bonus_factor)
        .when(split, F.coalesce(split_factor, F.lit(1.0)))
        .otherwise(F.lit(1.0))
    )
