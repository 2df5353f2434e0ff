"""Spark-native table preparation, modelling and explanation."""

from tableloom.plans.options import ExplainOptions, ModelOptions, PrepareOptions
from tableloom.plans.prepare import PreparePlan, fit_prepare
from tableloom.plans.study import Study, run_study

__all__ = [
    "ExplainOptions",
    "ModelOptions",
    "PrepareOptions",
    "PreparePlan",
    "Study",
    "fit_prepare",
    "run_study",
]
