"""parley: chat-corpus tables on Spark.

Turns exported or streamed chat messages into question/answer training tables, with
calendar analytics and text-similarity scores beside it.  Everything is a function from
DataFrame to DataFrame (or Column to Column), meant to be chained with ``.transform``.
"""

import sys

from pyspark import cloudpickle

from parley.schema import MESSAGE_SCHEMA, QA_SCHEMA
from parley.session import build_session

__all__ = ["MESSAGE_SCHEMA", "QA_SCHEMA", "build_session"]

# Send the few Python helpers to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
