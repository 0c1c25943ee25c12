"""Text-asset analytics on Spark: catalogs, glossaries, quote corpora, reviews.

Sub-packages: ``sources`` (readers and writers), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame), ``plans`` (composed
pipelines and the registered queries), ``streaming`` (incremental versions) and
the optional ``llm`` package, which nothing here imports.
"""

__version__ = "0.1.0"
