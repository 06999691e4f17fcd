"""tallyforge: a Spark-first analytics engine for job-market data.

Every operator is a function from DataFrames to a DataFrame; nothing runs
until the caller writes or collects the result.
"""
