"""Daily entity-activity reports as Spark DataFrame plans."""

from .functions.window import ReportWindow
from .operators.report import DailyReport
from .operators.specs import Child, Header, Metric, ReportSpec, Source, SpineSpec
from .session import ensure_checkpoint_dir, get_session
from .sources.catalog import Catalog

__all__ = ["ReportWindow", "DailyReport", "Child", "Header", "Metric", "ReportSpec", "Source", "SpineSpec",
           "ensure_checkpoint_dir", "get_session", "Catalog"]
