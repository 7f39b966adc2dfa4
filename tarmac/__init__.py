"""tarmac — flight, fare and weather analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame(s) -> DataFrame`` with its thresholds
as keyword parameters. Nothing is collected to the driver; Catalyst and AQE
pick the physical plan.
"""

__version__ = "0.1.0"
