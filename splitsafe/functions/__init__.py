"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from .hashing import gaussian, hash_int, hash_uniform  # noqa: F401
from .numeric import as_double, guarded_corr, nan_to_null, round6, round_half_even  # noqa: F401
from . import tiers  # noqa: F401
