"""Training-data operators: one module per operator, registered in ``plans``.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
