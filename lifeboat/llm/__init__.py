"""Training-data operators: thirteen corpus operators and the queries that apply them.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only when it is there.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
