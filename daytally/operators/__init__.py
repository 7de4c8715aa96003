from .keyfilter import bitmap, estimated_bytes, reduced
from .measure import Measure
from .report import DailyReport
from .spine import account_map, build_spine, department_map
from .specs import CONSTANT, DISTINCT, PAIRS, Child, Header, Metric, ReportSpec, Source, SpineSpec

__all__ = [
    "bitmap", "estimated_bytes", "reduced",
    "Measure", "DailyReport",
    "account_map", "build_spine", "department_map",
    "CONSTANT", "DISTINCT", "PAIRS", "Child", "Header", "Metric", "ReportSpec", "Source", "SpineSpec",
]
