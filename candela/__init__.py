"""candela: market time-series analytics expressed as Spark DataFrame plans.

Every public operator takes DataFrames and returns a DataFrame.  Nothing is
collected to the driver except model coefficients whose size is bounded by
the model (window length), never by the data.
"""

__version__ = "0.1.0"
