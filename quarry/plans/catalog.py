"""Imports every plan module so that their queries register themselves."""

from quarry.plans import aggregates, bakeoff, evaluation, glm, models, oof, prep, roundtrips, sequences, series, tabular, text  # noqa: F401
from quarry.plans.registry import REGISTRY  # noqa: F401
