"""DataFrame operators: each takes DataFrames and column names and returns a DataFrame, without running a job.

The exception is model fitting in ``forecast``, which has to run jobs to choose a model.
"""
