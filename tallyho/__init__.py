"""tallyho: text statistics, least-squares, sparse logistic regression and
matrix factorisation as Spark DataFrame operators."""

__version__ = "0.1.0"
