"""Business parameters. All values here are fixed: results depend on them."""

from __future__ import annotations

from dataclasses import dataclass, field

# Loss given default by contract type, (with collateral, without).
LGD_BY_CONTRACT = {
    "Cash loans": (0.55, 0.75),
    "Revolving loans": (0.70, 0.85),
    "Consumer loans": (0.45, 0.65),
}
LGD_DEFAULT = 0.65

# Credit conversion factor by contract type.
CCF_BY_CONTRACT = {"Cash loans": 0.40, "Revolving loans": 0.75, "Consumer loans": 0.40}
CCF_DEFAULT = 0.50
UNDRAWN_SHARE = 0.20

# LGD shifts of the sensitivity table.
LGD_SHIFTS = {
    "Optimistic (LGD - 15%)": -0.15,
    "Base Case": 0.00,
    "Adverse   (LGD + 15%)": 0.15,
    "Severe    (LGD + 30%)": 0.30,
}


@dataclass(frozen=True)
class Scenario:
    weight: float
    pd_scalar: float
    gdp_growth: float
    unemployment: float


# Macro scenarios of the forward-looking overlay.
MACRO_SCENARIOS = {
    "Optimistic": Scenario(weight=0.20, pd_scalar=0.85, gdp_growth=0.075, unemployment=0.018),
    "Base": Scenario(weight=0.50, pd_scalar=1.00, gdp_growth=0.065, unemployment=0.022),
    "Adverse": Scenario(weight=0.20, pd_scalar=1.35, gdp_growth=0.030, unemployment=0.045),
    "Severe": Scenario(weight=0.10, pd_scalar=1.75, gdp_growth=-0.010, unemployment=0.080),
}

# Monthly PD scalars per macro path and the path weights.
MACRO_PATHS = {
    "Optimistic": (0.98, 0.97, 0.96, 0.95, 0.94, 0.93, 0.92, 0.91, 0.90, 0.89, 0.88, 0.87),
    "Base": (1.0,) * 12,
    "Adverse": (1.05, 1.08, 1.10, 1.12, 1.13, 1.15, 1.16, 1.17, 1.18, 1.19, 1.20, 1.20),
    "Severe": (1.10, 1.18, 1.25, 1.32, 1.38, 1.45, 1.50, 1.54, 1.57, 1.60, 1.62, 1.65),
}
PATH_WEIGHTS = {"Optimistic": 0.20, "Base": 0.50, "Adverse": 0.20, "Severe": 0.10}
MONTHLY_RUNOFF = 0.985


@dataclass(frozen=True)
class StageRule:
    """Impairment stage thresholds. Outcome flags are not used: they are unknown when staging."""

    pd_stage2: float = 0.20
    pd_stage3: float = 0.70
    late_ratio: float = 0.30
    refused_ratio: float = 0.50


@dataclass(frozen=True)
class RoiParams:
    margin: float = 0.035
    lgd: float = 0.65
    opex: float = 50.0
    opportunity: float = 0.01


@dataclass(frozen=True)
class TierConfig:
    """Risk tiers: right-closed PD intervals."""

    edges: tuple[float, ...]
    labels: tuple[str, ...] = ("Very Low", "Low", "Medium", "High")
    threshold: float | None = None
    model: str | None = None


TIER_LABELS = ("Very Low", "Low", "Medium", "High")
TIER_QUANTILES = (0.40, 0.65, 0.85)
# Tier edges used when no fitted configuration exists.
FALLBACK_TIER_EDGES = (0.0, 0.279, 0.457, 0.649, 1.0)

SENTINEL_DAYS = 365243
REFERENCE_DATE = "2016-06-01"
HIGH_RISK_PD = 0.48

WEEKDAYS = {
    "MONDAY": "Mon", "TUESDAY": "Tue", "WEDNESDAY": "Wed", "THURSDAY": "Thu",
    "FRIDAY": "Fri", "SATURDAY": "Sat", "SUNDAY": "Sun",
}

# Credit bands and recommendation texts by tier.
CREDIT_BANDS = {"Very Low": "Excellent", "Low": "Good", "Medium": "Fair", "High": "Poor"}
RECOMMENDATIONS = {
    "Very Low": "AUTO-APPROVE: Eligible for fast-track approval and preferential rate.",
    "Low": "STANDARD: Approve via standard process. Income verification recommended.",
    "Medium": "CONDITIONAL: Approve with conditions — reduce limit by 20%, require documentation.",
    "High": "REVIEW: Manual underwriter review required. Consider collateral or co-borrower.",
}
TIER_POLICIES = {
    "Very Low": "Auto-approve, preferential rate",
    "Low": "Standard approval",
    "Medium": "Conditional approval + income verification",
    "High": "Manual review / collateral required",
}


@dataclass(frozen=True)
class FieldRange:
    """Accepted range of a scoring input; a null bound is open."""

    low: float | None = None
    high: float | None = None
    low_open: bool = False


# Accepted ranges of the scoring inputs.
SCORING_RANGES = {
    "ext_source_1": FieldRange(0, 1),
    "ext_source_2": FieldRange(0, 1),
    "ext_source_3": FieldRange(0, 1),
    "amt_credit": FieldRange(0, None, True),
    "amt_income_total": FieldRange(0, None, True),
    "amt_annuity": FieldRange(0, None, True),
    "amt_goods_price": FieldRange(0, None, True),
    "age_years": FieldRange(18, 70),
    "years_employed": FieldRange(0, None),
    "cnt_children": FieldRange(0, 15),
    "bureau_bad_debt_flag": FieldRange(0, 1),
    "prev_refused_ratio": FieldRange(0, 1),
    "inst_late_ratio": FieldRange(0, 1),
    "cc_utilization_mean": FieldRange(0, None),
    "bureau_loan_count": FieldRange(0, None),
}


@dataclass(frozen=True)
class Alert:
    """A monitored metric breaches when it is beyond `limit` on the given side."""

    metric: str
    limit: float
    above: bool
    action: str


# Monitoring thresholds and actions, most severe first per metric.
ALERTS = (
    Alert("psi", 0.25, True, "Retrain"),
    Alert("psi", 0.10, True, "Investigate"),
    Alert("csi_max", 0.10, True, "Investigate"),
    Alert("brier", 0.10, True, "Recalibrate"),
    Alert("auc", 0.73, False, "Retrain"),
    Alert("ecl_delta_pct", 10.0, True, "Model review"),
)


@dataclass(frozen=True)
class Bins:
    """Right-closed bins with labels."""

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    include_lowest: bool = False


# Bins of the segment, vintage and cohort views.
TERM_BINS = Bins((-1, 18, 30, 42, 56, 9999), ("≤18m", "24m", "36m", "48m", "60m+"))
LTI_BINS = Bins((-1, 1, 2, 3, 5, 999), ("0–1×", "1–2×", "2–3×", "3–5×", ">5×"))
DTI_BINS = Bins((-1, 0.10, 0.20, 0.30, 0.50, 9), ("0–10%", "10–20%", "20–30%", "30–50%", ">50%"))
CREDIT_BINS = Bins((0, 100e3, 200e3, 300e3, 500e3, 9e9), ("$0–100k", "$100–200k", "$200–300k", "$300–500k", "$500k+"))
PD_BANDS = Bins(
    (0, 0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 1.01),
    ("0–10%", "10–20%", "20–30%", "30–40%", "40–50%", "50–60%", "60–70%", "70–80%", "80–90%", "90–100%"),
)
TERM_BUCKETS = Bins((0, 12, 18, 24, 36, 60), ("0-12m", "12-18m", "18-24m", "24-36m", "36m+"), True)
AGE_BANDS = Bins((17, 25, 35, 45, 55, 70), ("18-25", "26-35", "36-45", "46-55", "56+"), True)
TENURE_BANDS = Bins((-0.01, 1, 3, 5, 10, 20), ("<1yr", "1-3yr", "3-5yr", "5-10yr", ">10yr"), True)

# Dashboard choices for family status and loan term.
FAMILY_CHOICES = {
    "Married": ("Married",),
    "Single": ("Single / not married", "Separated", "Widow"),
    "Divorced": ("Separated",),
}
TERM_CHOICES = {"12": "≤18m", "24": "24m", "36": "36m", "60+": "60m+"}


@dataclass(frozen=True)
class SegmentFilter:
    family: tuple[str, ...] = ()
    region: int | None = None
    tiers: tuple[str, ...] = ()
    terms: tuple[str, ...] = ()


@dataclass(frozen=True)
class SearchSpace:
    """Random-search ranges for the boosted-tree model (fixed values)."""

    trees: tuple[int, int] = (200, 2000)
    leaves: tuple[int, int] = (16, 127)
    depth: tuple[int, int] = (3, 10)
    step: tuple[float, float] = (0.005, 0.15)
    subsample: tuple[float, float] = (0.50, 1.00)
    min_rows: tuple[int, int] = (10, 200)
    min_gain: tuple[float, float] = (0.0, 1.0)
    columns: tuple[float, float] = (0.30, 1.00)
    l1: tuple[float, float] = (1e-5, 10.0)
    l2: tuple[float, float] = (1e-5, 10.0)
    min_weight: tuple[float, float] = (1e-3, 10.0)
    seed: int = 42


STAGE_RULE = StageRule()
ROI_PARAMS = RoiParams()
CLEAN_KEEP = ("ext_source_1", "ext_source_2", "ext_source_3")


@dataclass(frozen=True)
class ApplicationCleaning:
    """What the application cleaner does, beyond the fixed order of its steps."""

    sparse_limit: float = 0.40
    keep: tuple[str, ...] = CLEAN_KEEP
    caps: dict[str, float] = field(
        default_factory=lambda: {
            "amt_req_credit_bureau_qrt": 12.0,
            "def_30_cnt_social_circle": 20.0,
            "def_60_cnt_social_circle": 20.0,
            "obs_30_cnt_social_circle": 100.0,
            "obs_60_cnt_social_circle": 100.0,
        }
    )
    income_quantile: float = 0.99
