"""corpusloom: text-corpus preparation and evaluation as Spark jobs.

Column helpers live in ``functions``, DataFrame-to-DataFrame steps in ``operators``, readers and
writers in ``sources``, multi-step corpora and evaluations in ``plans``, keyed state in ``streaming``.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel inside the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
