"""lontar: analytics on structured text documents, written for Spark DataFrames.

Subpackages: ``operators`` (relational and structural transforms), ``functions``
(column expressions), ``sources`` (readers and writers), ``plans`` (named queries and
their SQL), ``streaming`` (incremental forms) and ``llm`` (operators for training text,
which nothing else here imports).
"""

__version__ = "0.1.0"
