"""claimlake: a Spark-native engine for building and analysing fact-check corpora.

Everything is a ``DataFrame -> DataFrame`` function.  Rejected rows stay
visible: status and errors are columns, never exceptions.
"""

__version__ = "0.1.0"
