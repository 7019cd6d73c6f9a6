"""Reusable DataFrame operators; each takes column names as arguments."""

from truetally.operators.keys import arg_latest, latest_per_key  # noqa: F401
from truetally.operators.cumulative import first_reach_date, running_total  # noqa: F401
from truetally.operators.allocate import proportional_allocate  # noqa: F401
from truetally.operators.windows import mark_latest, trailing_window_sum, trailing_window_sum_join  # noqa: F401
from truetally.operators.resolve import fx_convert, resolve_first  # noqa: F401
from truetally.operators.security import apply_mask, apply_row_scope  # noqa: F401
