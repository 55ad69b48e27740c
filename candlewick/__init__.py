"""candlewick — market-trade analytics on Spark DataFrames, SQL and Structured Streaming.

Operators are plain functions ``DataFrame -> DataFrame`` (or builders of streaming
queries).  Every heavy step is expressed with the DataFrame API so Catalyst can push
filters, prune columns and pick join / aggregate strategies.
"""

__version__ = "0.1.0"
