"""Operations of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this package; the package may be removed
without affecting the recommender jobs.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
