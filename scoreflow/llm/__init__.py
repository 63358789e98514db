"""Training-data operators over the corpus tables (`documents`, `benchmark`,
`labels`, `conversations`). Nothing else in the library imports this
subpackage; `scoreflow.llm.queries` holds its registered queries.

Functions that run on executors are sent by value, so the package need not be
installed there."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
