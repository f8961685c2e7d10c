"""terrafold: landing, staging, curating and publishing recurring geographic
and demographic deliveries as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns), so steps
compose with ``DataFrame.transform`` and Catalyst sees one plan per job.
"""

__version__ = "0.1.0"
