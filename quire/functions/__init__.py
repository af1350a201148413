"""Column functions: strings and regular expressions (G1–G15), math and
vector scalars (H1–H6). All are built-in Spark expressions, so they stay
inside whole-stage code generation."""

from .strings import *  # noqa: F401,F403
from .math import *  # noqa: F401,F403
from .strings import __all__ as _s
from .math import __all__ as _m

__all__ = list(_s) + list(_m)
