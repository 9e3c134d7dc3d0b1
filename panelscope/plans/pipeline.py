"""End-to-end analysis pipeline: payroll + official tables -> one DataFrame per analysis.

Runs the analyses in methodology order. The payroll and the multi-level panel
feed many analyses, so both are persisted (MEMORY_AND_DISK) once; nothing is
collected. Errors propagate: no analysis is silently replaced by an empty
frame. ``write_outputs`` stores every result as one parquet (or CSV) table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.functions.cols import quarter_label
from panelscope.operators import assess as A
from panelscope.operators import births as B
from panelscope.operators import coverage as C
from panelscope.operators import earnings as E
from panelscope.operators import exhibits as X
from panelscope.operators import flows as FL
from panelscope.operators import growth as G
from panelscope.operators import panel as P
from panelscope.operators import quality as Q
from panelscope.operators import reweight as R
from panelscope.operators import tenure as T
from panelscope.sources.official import official_cells


@dataclass
class OfficialInputs:
    """Normalised official tables: QCEW long (``unpivot_qcew_months`` + ``qcew_keys``),
    CES (``normalise_ces``) and BED (``normalise_bed``); any may be None."""
    qcew_long: DataFrame | None = None
    ces: DataFrame | None = None
    bed: DataFrame | None = None
    ces_total: str = "Total private"


class Outputs(dict):
    """Analyses by name; :meth:`release` frees what :func:`run_pipeline` keeps for them."""

    def __init__(self):
        super().__init__()
        self.kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.kept[-1]

    def release(self) -> None:
        while self.kept:
            self.kept.pop().unpersist()


def run_pipeline(payroll: DataFrame, official: OfficialInputs, stable: bool = False,
                 employees: DataFrame | None = None, persist: bool = True) -> Outputs:
    """All analyses as lazy DataFrames keyed by name. With ``persist``, payroll and panel are kept until ``release()``."""
    out = Outputs()
    if stable:
        payroll = P.filter_stable_panel(payroll, 12)
    if persist:
        payroll = out.keep(payroll)

    flagged, dq_summary = Q.flag_data_quality_issues(payroll)
    out["dq_summary"] = dq_summary
    out["dq_scorecard"] = A.quality_scorecard(payroll)
    out["completeness"] = A.column_completeness(payroll)
    out["client_tenure"] = T.compute_client_tenure(payroll)
    out["entry_exit"] = T.compute_client_entry_exit(payroll, [])
    out["vintage_shares"] = T.compute_vintage_shares(payroll)

    panel = P.build_panel(payroll)
    if persist:
        panel = out.keep(panel)
    out["panel"] = panel
    national = P.panel_level(panel, "national")
    by_ss = P.panel_level(panel, "supersector")

    if official.qcew_long is not None:
        off_nat = official_cells(official.qcew_long, [], "national")
        off_ss = official_cells(official.qcew_long, ["supersector"], "national")
        off_ss_state = official_cells(official.qcew_long, ["supersector", "state_fips"], "state")
        cov_nat = C.compute_coverage_over_time(national, off_nat, [])
        cov_cells = C.compute_cell_reliability(
            C.compute_coverage(P.panel_level(panel, "supersector_state"), off_ss_state, ["supersector", "state_fips"]))
        out["coverage_national"] = cov_nat
        out["coverage_supersector"] = C.compute_coverage(by_ss, off_ss, ["supersector"])
        out["cell_reliability"] = cov_cells
        out["share_comparison"] = C.compute_share_comparison(by_ss, off_ss, "supersector")
        out["coverage_matrix"] = X.coverage_matrix(cov_cells)
        out["usability_matrix"] = X.usability_matrix(cov_cells)
        out["headline_coverage"] = X.headline_coverage(cov_nat)
        raked = R.rake_to_qcew(payroll, off_ss, ["supersector"])
        out["reweighted_growth"] = G.compute_growth_rates(raked, "qualified_employment", [], "rake_weight")
    out["csi"] = X.csi_by_dimension({
        "supersector": C.compute_composition_shift_index(by_ss, "supersector"),
        "state_fips": C.compute_composition_shift_index(P.panel_level(panel, "state"), "state_fips"),
        "size_class": C.compute_composition_shift_index(P.panel_level(panel, "size_class"), "size_class"),
    })

    growth = G.compute_growth_rates(payroll, "qualified_employment", [])
    out["growth"] = growth
    out["employment_change"] = G.decompose_employment_change(payroll)
    if official.ces is not None:
        ces_total = official.ces.filter(F.col("supersector") == official.ces_total)
        ces_cells = official.ces.filter(F.col("supersector") != official.ces_total)
        ces_growth = G.compute_growth_rates(ces_total, "employment", [])
        out["growth_comparison"] = G.compare_growth(growth, ces_growth, [])
        out["turning_points"] = G.analyze_turning_points(growth, ces_growth)
        out["divergence"] = G.decompose_growth_divergence(
            by_ss, ces_cells.withColumn("quarter", quarter_label("ref_date")), ["supersector"])
        if "reweighted_growth" in out:
            out["reweighting_impact"] = R.reweighting_impact(growth, out["reweighted_growth"])

    out["flows"] = FL.compute_job_flows(employees if employees is not None else payroll, [])
    if "gross_pay" in payroll.columns:
        out["earnings"] = E.compute_earnings_growth(payroll, [])

    births = B.compute_payroll_birth_rates(national, [])
    out["birth_rates"] = births
    out["survival"] = B.compute_survival_curves(payroll)
    if official.bed is not None:
        bed_nat = B.official_birth_rates(official.bed)
        out["birth_comparison"] = B.compare_birth_rates(births, bed_nat, [])
        out["birth_lead"] = B.test_birth_lead(births, bed_nat)
        out["cross_correlation"] = B.compute_cross_correlation(births, bed_nat)
    return out


def write_outputs(outputs: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    X.write_outputs(outputs, path, fmt)
