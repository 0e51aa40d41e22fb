"""Whole analyses composed of the operators."""

from tallyframe.plans.modelling import Modelling, join_models, run_models
from tallyframe.plans.preparation import prepare_training_set
from tallyframe.plans.selection import FeatureSelection, select_features

__all__ = [
    "FeatureSelection",
    "Modelling",
    "join_models",
    "prepare_training_set",
    "run_models",
    "select_features",
]
