"""All registered queries."""

from oddrows.plans import detectors, flows, models, scores, series, tables  # noqa: F401
from oddrows.plans.registry import ORACLES, QUERIES  # noqa: F401
