"""Training-data pipeline operators: quality rules, line and document near-duplicates,
repeated passages, benchmark contamination, chat formatting, sharding, source mixing,
language-model scoring, toxicity, conversation repair, source divergence and set joins.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``. ``queries.py``
binds them to the test tables. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value: their workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
