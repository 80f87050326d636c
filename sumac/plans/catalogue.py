"""Imports every binding module so that the registry is complete."""

from sumac.plans import basics, cleaning, customers, distances, evaluation, explanation, flows, modelling, profiling, storage  # noqa: F401
from sumac.plans.registry import ORACLES, QUERIES  # noqa: F401
