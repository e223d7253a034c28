"""Training-data operators (deduplication, decontamination, tokenising, quality, sharding ...).

Nothing outside this folder imports it. Helper functions that run inside tasks are
pickled by value, so executors need numpy, pyarrow and pyspark but not this package.
"""

from pyspark import cloudpickle

import trendspark

cloudpickle.register_pickle_by_value(trendspark)
