from tarnlake.sources.documents import read_documents, scan_documents
from tarnlake.sources.files import read_csv_dim
from tarnlake.sources.jdbc import KeyRange, read_jdbc
from tarnlake.sources.schemas import infer_schema_once

__all__ = [
    "KeyRange",
    "infer_schema_once",
    "read_csv_dim",
    "read_documents",
    "read_jdbc",
    "scan_documents",
]
