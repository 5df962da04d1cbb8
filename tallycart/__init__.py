"""tallycart: retail analytics as Spark jobs (star schema, reports, measures, statistics, forecasts)."""

import sys

from pyspark import cloudpickle

from tallycart.sources.warehouse import Warehouse

# functions that run inside tasks travel with the task, so executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Warehouse"]
