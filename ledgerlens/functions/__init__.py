"""Column-expression helpers (all JVM-side built-ins, no Python per row)."""

from ledgerlens.functions.columns import *  # noqa: F401,F403
