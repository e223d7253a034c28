"""trendspark: per-entity trend analytics on Spark DataFrames.

Main entry points (see README for the full operator map):

* ``plans.models.build_from_landing`` - landed JSONL + seed -> all marts
* ``operators.sequence.sequence`` / ``number_rows`` - skew-safe entity sequences
* ``operators.trends.rolling_trends`` - rolling / expanding averages, percent ranks
* ``operators.baseline.match_deltas`` - prior baselines, z-scores, prior percentiles
* ``operators.marts.champion_meta`` - pick / ban / presence / win rates
* ``operators.scd2.scd2_merge`` / ``as_of`` - type-2 history
* ``operators.quality`` - checks returning failing rows
* ``sources.upsert.upsert`` / ``load_batch`` - idempotent keyed upsert
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value: executors need pyspark, numpy and
# pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

__all__ = ["__version__"]
