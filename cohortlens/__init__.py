"""cohortlens — per-subject feature tables and model evaluation on Spark.

Everything is expressed as DataFrame -> DataFrame functions so that Catalyst
plans the work; numpy/pandas only run inside Spark tasks for small per-group
linear algebra (k x k solves).
"""

__version__ = "0.1.0"
