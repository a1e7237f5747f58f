"""salesmart: a retail KPI mart written as composable Spark DataFrame operators.

raw sales text -> tagged, validated, deduplicated fact -> KPI tables -> one nested report.
Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst plans it and it runs unchanged on a laptop or a large cluster.
"""

__version__ = "0.1.0"
