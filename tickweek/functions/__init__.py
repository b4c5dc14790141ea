"""Column-level functions (all built-in Spark expressions, no Python UDFs)."""

from tickweek.functions.calendar import (  # noqa: F401
    cast_date,
    day_of_week,
    days_duration,
    duration_days,
    iso_date_text,
    parse_date,
    subtract_duration,
    week_start,
)
from tickweek.functions.json import contains, field_of_each, first_element, json_text, parse_json  # noqa: F401
from tickweek.functions.numeric import mid_price, to_double  # noqa: F401
from tickweek.functions.text import comma_to_dot, field, normalise_sector  # noqa: F401
from tickweek.functions.vehicles import vehicle_age, wear_and_tear  # noqa: F401
