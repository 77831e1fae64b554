"""Column-expression builders (JVM-side, whole-stage-codegen friendly)."""

from fleetscope.functions.expr import *  # noqa: F401,F403
