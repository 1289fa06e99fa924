"""millrace: event-stream ETL and document collections as plain Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function. See README.md for the
map from capability to module.
"""

import sys

from pyspark import cloudpickle

# Executors get the task functions themselves, so the package need not be
# installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from millrace.session import build_session, shared_dir  # noqa: E402

__all__ = ["build_session", "shared_dir"]
