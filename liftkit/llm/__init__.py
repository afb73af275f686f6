"""Operations of a training-data pipeline: extraction, repeats, languages, licences,
similarity joins, mixing, packing, exact copies, address filters and vector search."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
