"""skein: a Spark-first engine for building, tracking and analysing large text corpora."""

__version__ = "0.1.0"
