"""All registered queries; importing the query modules fills the registry."""

from bandlore.plans import (  # noqa: F401
    queries_evaluate,
    queries_fitted,
    queries_models,
    queries_profile,
    queries_score,
)
from bandlore.plans.registry import ORACLE, QUERIES


def flagship(spark, sf_dir):
    return QUERIES["model_benchmark"](spark, sf_dir)
