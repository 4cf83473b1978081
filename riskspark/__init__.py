"""riskspark: credit-risk portfolio analytics and batch scoring on Spark DataFrames."""

__version__ = "0.1.0"
