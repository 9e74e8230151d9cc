"""Sightline: Spark operators for security-indicator sightings.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing is
collected to the driver and every operator that depends on the current day takes it
as ``as_of``.
"""

__version__ = "0.1.0"
