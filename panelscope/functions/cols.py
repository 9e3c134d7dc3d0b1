"""Column helpers shared by loaders and operators (all JVM-side expressions)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2-digit NAICS sector -> CES supersector name.
SUPERSECTOR_MAP: dict[str, str] = {
    "11": "Mining and logging",
    "21": "Mining and logging",
    "22": "Utilities",
    "23": "Construction",
    "31": "Manufacturing",
    "32": "Manufacturing",
    "33": "Manufacturing",
    "42": "Wholesale trade",
    "44": "Retail trade",
    "45": "Retail trade",
    "48": "Transportation and warehousing",
    "49": "Transportation and warehousing",
    "51": "Information",
    "52": "Financial activities",
    "53": "Financial activities",
    "54": "Professional and business services",
    "55": "Professional and business services",
    "56": "Professional and business services",
    "61": "Education and health services",
    "62": "Education and health services",
    "71": "Leisure and hospitality",
    "72": "Leisure and hospitality",
    "81": "Other services",
}
DEFAULT_SUPERSECTOR = "Other services"

# QCEW-style establishment size classes and their upper bounds.
SIZE_CLASS_LABELS: list[str] = ["1-4", "5-9", "10-19", "20-49", "50-99", "100-249", "250-499", "500+"]
SIZE_CLASS_UPPERS: list[int] = [4, 9, 19, 49, 99, 249, 499]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def td(num, den) -> Column:
    """Division that yields NULL on a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pad6(c, trim: bool = True) -> Column:
    """Left zero-pad an industry code to 6 characters (trimmed first by default).

    ``lpad`` truncates longer input, so longer codes pass through unchanged.
    """
    s = _c(c).cast("string")
    s = F.trim(s) if trim else s
    return F.when(F.length(s) >= 6, s).otherwise(F.lpad(s, 6, "0"))


def naics2(c) -> Column:
    return F.substring(pad6(c), 1, 2)


def naics3(c) -> Column:
    return F.substring(pad6(c), 1, 3)


def _supersector_map_col() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(SUPERSECTOR_MAP.items())])


def supersector_of(code2) -> Column:
    """Supersector name for a 2-character sector code; unknown or NULL -> 'Other services'."""
    return F.coalesce(F.element_at(_supersector_map_col(), _c(code2)), F.lit(DEFAULT_SUPERSECTOR))


def size_class(emp) -> Column:
    """Size-class label; values <= 0 go to '1-4' and NULL falls through to '500+'."""
    e = _c(emp)
    expr = F.when(e <= 0, F.lit(SIZE_CLASS_LABELS[0]))
    for upper, label in zip(SIZE_CLASS_UPPERS, SIZE_CLASS_LABELS):
        expr = expr.when(e <= upper, F.lit(label))
    return expr.otherwise(F.lit(SIZE_CLASS_LABELS[-1]))


def quarter_label(d) -> Column:
    """'YYYYQn' label of a date."""
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def days_over_30(later, earlier) -> Column:
    """Month difference as whole days / 30 (the convention used throughout)."""
    return F.datediff(_c(later), _c(earlier)) / F.lit(30.0)
