"""demandlens: job-demand analytics as plain Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function with column
names as arguments.  The work stays inside Spark (DataFrame API, Spark SQL,
MLlib); nothing is pulled through the driver on a data path.
"""

__version__ = "0.1.0"
