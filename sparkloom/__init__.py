"""sparkloom: a Spark-first analytics toolkit (sessions, typed results, functions, workloads)."""

__version__ = "0.1.0"
