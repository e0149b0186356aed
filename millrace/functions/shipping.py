"""Let executors run the Python helpers of this package without installing it there."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Send the functions and classes of ``module`` with the tasks that use them."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
