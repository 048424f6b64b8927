"""Document-text pipelines and pipeline monitoring as Spark DataFrame jobs.

Every public operator is a ``DataFrame -> DataFrame`` transform without actions,
so it composes with ``df.transform`` and runs unchanged in batch and inside a
Structured Streaming ``foreachBatch``.
"""

__version__ = "0.1.0"
