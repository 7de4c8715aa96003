from .catalog import Catalog
from .jdbc import JdbcConfig, Partitioning, jdbc_options, read_jdbc, read_jdbc_window, time_slice_predicates, with_key_ranges
from .sinks import Staged, publish, write_partitioned

__all__ = ["Catalog", "JdbcConfig", "Partitioning", "jdbc_options", "read_jdbc", "read_jdbc_window",
           "time_slice_predicates", "write_partitioned", "Staged", "publish", "with_key_ranges"]
