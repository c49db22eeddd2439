"""All registered queries of this package."""

from mediaspark.llm import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13  # noqa: F401
from mediaspark.llm.registry import ORACLES, QUERIES, VARIANT_ORACLES, VARIANTS

__all__ = ["ORACLES", "QUERIES", "VARIANTS", "VARIANT_ORACLES"]
