"""Operators for preparing training data.  Nothing else in the package imports this folder.

All operators drop input columns whose names clash (in any letter case) with their own
outputs before they add those, so extra columns never make them fail.
"""

from __future__ import annotations
