"""Operators for preparing training data: one module per operator.

Task functions of this package are shipped to the executors by value, so the
package has to be importable on the driver only.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
