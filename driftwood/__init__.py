"""driftwood: online and streaming analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers/writers (ARFF, example text, command streams, generators)
functions  Column -> Column helpers (vectors, tests, statistics, losses)
operators  DataFrame -> DataFrame operators (ordered scans, sketches, learners)
plans      shared plan building blocks (two-level ordered scan, table loading)
streaming  Structured Streaming forms of the stateful operators
"""

from driftwood.session import checkpoint_dir, get_spark  # noqa: F401

__version__ = "0.1.0"
