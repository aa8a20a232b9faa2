"""feedmill: batch feed analytics as plain DataFrame-to-DataFrame functions."""

from feedmill.fields import Field, Layout
from feedmill.plans.steps import resolve_outputs, row_counts, run_step, run_steps

__all__ = [
    "Field",
    "Layout",
    "resolve_outputs",
    "row_counts",
    "run_step",
    "run_steps",
]
