"""Named queries over the supplied tables."""

from rulspark.plans import evaluation, exploration, forecasts, layers, learning, windows  # noqa: F401
from rulspark.plans.registry import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
