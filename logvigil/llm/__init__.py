"""Operators for large training corpora: tokens, duplicates, shards, filters, classifiers, mixing."""

from pyspark import cloudpickle

import logvigil.llm as _package

# Functions sent to the executors carry their code with them, so these need no copy of the package.
cloudpickle.register_pickle_by_value(_package)
