"""Training-data operators: one module per operator, registered in ``queries``."""
import sys

from pyspark import cloudpickle

# tasks get this subpackage's functions with the job: executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
