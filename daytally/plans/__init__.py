from . import fixture, layout, reference_schema
from .queries import fixture_report, queries

__all__ = ["fixture", "layout", "reference_schema", "fixture_report", "queries"]
