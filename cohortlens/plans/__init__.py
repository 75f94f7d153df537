"""Composed jobs and the registry of named queries.

Importing this package registers every query module.
"""

from cohortlens.plans import registry  # noqa: F401
from cohortlens.plans import q_metrics  # noqa: F401
from cohortlens.plans import q_tidy  # noqa: F401
from cohortlens.plans import q_signal  # noqa: F401
from cohortlens.plans import q_splits  # noqa: F401

from cohortlens.plans import q_models  # noqa: F401
from cohortlens.plans import q_sources  # noqa: F401
