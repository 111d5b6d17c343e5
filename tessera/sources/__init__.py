from tessera.sources.contracts import RELATIONAL, RELATIONAL_ORDER, ColumnSpec, ForeignKey, TableContract
from tessera.sources.readers import (
    DEFAULT_CSV, ContractError, CsvContract, csv_header, list_files, preview, read_csv_strings,
    read_json_documents, read_seed, typed_by_name,
)
from tessera.sources.sinks import extract_tables, to_csv_strings, write_csv

__all__ = [
    "RELATIONAL", "RELATIONAL_ORDER", "ColumnSpec", "ForeignKey", "TableContract", "DEFAULT_CSV",
    "ContractError", "CsvContract", "csv_header", "list_files", "preview", "read_csv_strings",
    "read_json_documents", "read_seed", "typed_by_name", "extract_tables", "to_csv_strings",
    "write_csv",
]
