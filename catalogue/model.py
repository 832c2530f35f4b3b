"""Fixed coefficients for the queries whose SQL counterpart cannot fit the whole model."""

from mirrorflow.operators.ols import LinearModel

INTERCEPT_VALUE = 1.0
SLOPES = {
    "log_dist": -0.145,
    "log_dist_sq": 0.009,
    "log_uv_exp": -0.025,
    "contig": 0.012,
    "landlocked_reporter": 0.0045,
    "landlocked_partner": 0.0065,
}
YEAR_EFFECTS = {
    "1995": 0.0,
    "1996": 0.006,
    "1997": 0.002,
    "1998": 0.009,
    "1999": 0.0025,
    "2000": 0.0044,
    "2001": 0.0043,
}

OLS_MODEL = LinearModel(
    coefficients={
        "(Intercept)": INTERCEPT_VALUE,
        **SLOPES,
        **{f"year{y}": b for y, b in YEAR_EFFECTS.items() if y != "1995"},
    },
    x=list(SLOPES),
    group="year",
    levels=list(YEAR_EFFECTS),
)

# a deliberately steeper model, so that some fitted values fall below the bounds
STEEP_INTERCEPT = 0.5
STEEP_SLOPE = -0.065
STEEP_MODEL = LinearModel({"(Intercept)": STEEP_INTERCEPT, "log_dist": STEEP_SLOPE}, ["log_dist"])
