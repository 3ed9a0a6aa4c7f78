"""Column-level functions: text, index arithmetic, arrays/maps/JSON."""

from . import arrays, index, text  # noqa: F401
