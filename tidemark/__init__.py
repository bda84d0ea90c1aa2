"""tidemark: derived time-series metrics as Spark DataFrame plans.

A metric is a small JSON expression (series math, window ops, composites,
nested to any depth).  ``tidemark.plans.compile`` turns it into one lazy
DataFrame over a *panel* of many series, so thousands of series (keys) are
evaluated by the same plan.
"""

from tidemark.model import OBS_TIME, SERIES_CODE, VALUE, SeriesPanel
from tidemark.plans.compile import evaluate

__all__ = ["OBS_TIME", "SERIES_CODE", "VALUE", "SeriesPanel", "evaluate"]
