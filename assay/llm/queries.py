"""All registered queries of the subpackage."""

from assay.llm import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13  # noqa: F401  (importing registers)
from assay.llm._common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
