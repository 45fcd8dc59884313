"""Importing this module registers every job."""

from armature.plans import (  # noqa: F401
    jobs_corpus,
    jobs_evaluation,
    jobs_mixture,
    jobs_sources,
    jobs_steps,
    jobs_streams,
    jobs_tokens,
    jobs_trajectories,
)
from armature.plans.registry import ORACLES, QUERIES  # noqa: F401
