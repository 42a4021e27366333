"""Sensor analytics on Spark: traffic, parking and energy rollups plus warehouse upkeep.

Every operator takes and returns DataFrames and stays lazy, so a caller can chain
operators into one Catalyst plan.  Times in operator contracts are epoch microseconds
(``long``) unless a name says otherwise.
"""

__version__ = "0.1.0"
