"""Fixed parameters of the registered queries (shared by Spark and oracle)."""

from datetime import date, datetime

# Fixed values used by the query catalogue and its oracle SQL.
AS_OF = datetime(2024, 1, 15, 12, 30, 0)
COUNTRY = "NATION_7"
DAY = date(2024, 1, 15)
STATES_PER_PART = 10_000
