"""contentflow: content-pipeline analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (readers/sinks), ``functions`` (Column helpers),
``operators`` (DataFrame -> DataFrame operators), ``plans`` (bindings,
registered queries, oracle SQL), ``streaming`` (Structured Streaming jobs).
"""

__version__ = "0.1.0"
