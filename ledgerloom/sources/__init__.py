from ledgerloom.sources.registry import SOURCES, SourceColumn, SourceTable, conform, require_columns

__all__ = ["SOURCES", "SourceColumn", "SourceTable", "conform", "require_columns"]
