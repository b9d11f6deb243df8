"""Fixed values.

These must equal the reference's for results to match.  They are stated here
once, plainly, and imported everywhere else; every operator also takes them as
parameters.
"""

# Marts and breakouts
TOP_N = 20                       # top entities kept per (snapshot, group)
RANK_LO, RANK_HI = 1, 20         # valid rank range checked on the top mart
MIN_STARS = 50                   # breakout floor: stars >= 50
VELOCITY_FACTOR = 3              # breakout: velocity > 3 x group median
VELOCITY_DIGITS = 2              # stars per day rounded to 2 decimals
MULTIPLIER_DIGITS = 1            # velocity multiplier rounded to 1 decimal
GROWTH_DIGITS = 2                # growth percent rounded to 2 decimals

# Staging
NO_LICENSE_SENTINEL = "NOASSERTION"   # licence id meaning "no licence asserted"

# Dashboard and report
KPI_DIGITS = 1                   # mean engagement KPI, 1 decimal, half-even
EMPTY_LABEL = "—"                # hottest-group KPI on an empty selection (em dash)
TOP_FOR_GROUP = 15               # ranked rows shown for one group
CHART_TOP = 15                   # breakouts in the multiplier bar chart
REPORT_TOP = 10                  # breakouts in the console report
SHORT_NAME_WIDTH = 34            # report name: last '/' segment, first 34 characters
EXPLORER_LIMIT = 50              # rows of the default explorer query

# Collector
SNAPSHOT_FILE = "snapshot.json"  # one combined file per dated directory
TRENDING_DAYS_BACK = 7           # created within the last 7 days
TRENDING_PER_PAGE = 50           # top 50 per group by stars
DEFAULT_GROUPS = "python,javascript,go,rust,java"  # configured group list
