"""Operations for preparing training text, each a Spark job of its own.

Nothing outside this folder, `corpus_pipeline.py` and `__spark_entry__.py`
imports it. Functions that run in tasks are sent by value, so executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
