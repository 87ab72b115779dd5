"""Learner-risk analytics on Spark: every step is a function from DataFrame to DataFrame."""

from cohortlens.params import RunParams

__all__ = ["RunParams"]
