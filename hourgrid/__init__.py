"""hourgrid: hourly energy-grid analytics as Spark DataFrame operators."""

__version__ = "0.1.0"

import os
import sys

from pyspark import cloudpickle

# Python workers find the package through PYTHONPATH or the working folder.  Where neither leads to it, the functions that
# run in tasks travel by value.
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if _ROOT not in {os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)}:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
