"""kestrel: term mentions, question/answer clustering and survey aggregation on Spark DataFrames.

Layout:
    kestrel.sources    line scans and parsers (page records, postings, headed wide CSV)
    kestrel.functions  column-expression helpers shared by the operators
    kestrel.operators  DataFrame -> DataFrame operators (mentions, qa, sampling, kmeans, survey)
    kestrel.plans      end-to-end flows and the driver query catalogue with its SQL oracles

Every operator takes DataFrames (and plain Python parameters) and returns a DataFrame; the
session is the caller's.  Nothing runs a Python UDF: all row work is built-in Spark expressions.
"""

__version__ = "0.1.0"
