from .columns import row_sum, zero_filled
from .window import ReportWindow, label

__all__ = ["row_sum", "zero_filled", "ReportWindow", "label"]
