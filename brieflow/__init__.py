"""brieflow: a PySpark-native news-briefing library.

Every operator is a ``DataFrame -> DataFrame`` function with explicit
parameters; lexicons and thresholds live in :mod:`brieflow.params`.
"""

__version__ = "0.1.0"
