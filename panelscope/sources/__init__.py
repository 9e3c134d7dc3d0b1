from panelscope.sources.payroll import (  # noqa: F401
    OPTIONAL_COLUMNS, REQUIRED_COLUMNS, load_employees, load_payroll, normalise_employees, normalise_payroll,
)
from panelscope.sources.official import (  # noqa: F401
    STATE_FIPS, combine_qcew, load_bed, load_ces, load_official, load_qcew, normalise_bed, normalise_ces, official_cells, qcew_keys,
    qcew_quarterly_dates, unpivot_qcew_months,
)
from panelscope.sources.tables import load_panel, read_by_year, save_panel, write_by_year  # noqa: F401
