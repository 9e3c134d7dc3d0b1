from panelscope.functions.cols import (  # noqa: F401
    SIZE_CLASS_LABELS, SUPERSECTOR_MAP, days_over_30, pad6, quarter_label, size_class,
    supersector_of, td, naics2, naics3,
)
