from loadpanel.sources.contract import DataSource, PanelTables
from loadpanel.sources.json_files import (
    parse_columnar,
    parse_rowwise,
    read_columnar,
    read_rowwise,
)
from loadpanel.sources.tables import load, replace_table, scan_entity

__all__ = [
    "DataSource",
    "PanelTables",
    "load",
    "parse_columnar",
    "parse_rowwise",
    "read_columnar",
    "read_rowwise",
    "replace_table",
    "scan_entity",
]
