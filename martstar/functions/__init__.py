"""Column-expression helpers shared by the operators (all JVM-side)."""

from .calendar import calendar_columns, date_id_of, date_of_id  # noqa: F401
from .checks import errors_array, rule  # noqa: F401
from .numeric import (lenient_double, mean_half_up, rounded_mean, rounded_mean_sql,  # noqa: F401
                      scaled)
