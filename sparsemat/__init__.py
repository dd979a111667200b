"""Sparse integer matrices on Spark DataFrames."""

from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .schema import (
    VECTOR,
    as_cells,
    check_bounds,
    coo_schema,
    resolve_duplicates,
    wrap_int32,
)
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources

__all__ = [
    *_functions,
    *_operators,
    *_sources,
    "VECTOR",
    "as_cells",
    "check_bounds",
    "coo_schema",
    "resolve_duplicates",
    "wrap_int32",
]
