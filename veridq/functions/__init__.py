"""Scalar primitives as Column factories (no UDF; all JVM-side, codegen-friendly)."""

from veridq.functions.exprs import *  # noqa: F401,F403
