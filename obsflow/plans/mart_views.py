"""The two marts as query texts, for views stored in a catalog.

They say what ``marts.daily_max`` and ``marts.daily_stats`` say, in the same order: reduce
per place and day, then join, then group by city.
"""

from __future__ import annotations

from obsflow.fixed_values import (
    COORDINATE_SCALE,
    DAILY_MAX_VIEW,
    DAILY_STATS_VIEW,
)
from obsflow.functions.scalars import exact_average


def _placed(hourly: str, location: str) -> str:
    return f"""WITH days AS (
    SELECT round(latitude, {COORDINATE_SCALE}) AS lat_key,
           round(longitude, {COORDINATE_SCALE}) AS lon_key,
           obs_date AS date,
           max(temp) AS high, min(temp) AS low, sum(temp) AS total, count(temp) AS n
    FROM {hourly}
    GROUP BY ALL
), placed AS (
    SELECT l.country, l.state, l.city, d.date, d.high, d.low, d.total, d.n
    FROM days d
    JOIN {location} l
      ON round(l.latitude, {COORDINATE_SCALE}) = d.lat_key
     AND round(l.longitude, {COORDINATE_SCALE}) = d.lon_key
)"""


def mart_queries(hourly: str, location: str) -> dict[str, str]:
    """View name to query, over the named base tables."""
    placed = _placed(hourly, location)
    return {
        DAILY_MAX_VIEW: f"""{placed}
SELECT country, state, city, date, month(date) AS month, max(high) AS max_temperature
FROM placed
GROUP BY country, state, city, date""",
        DAILY_STATS_VIEW: f"""{placed}
SELECT country, state, city, date,
       max(high) AS max_temperature,
       min(low) AS min_temperature,
       {exact_average("sum(total)", "sum(n)")} AS average_temperature
FROM placed
GROUP BY country, state, city, date""",
    }
