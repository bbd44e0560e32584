"""needlens: need-mining analytics on Spark.

Social posts (or any text table) are cleaned, deduplicated, clustered and
described; structured answers from a pluggable batch function are validated
into need records, which are profiled, scored, ranked and written as
specifications and a report.  Every step is a DataFrame operation.
"""

__version__ = "0.1.0"
