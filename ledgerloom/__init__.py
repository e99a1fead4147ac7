"""ledgerloom: a PySpark engine for messy public-sector records.

Every operator is a function from DataFrames to a DataFrame; nothing runs until the caller acts on the result, apart
from the few operators that say so (iterations, checks of a size before a broadcast).
"""

from ledgerloom.session import cut, get_session

__all__ = ["cut", "get_session"]
