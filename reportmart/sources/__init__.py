"""Landing documents, flat tables and staged tables."""

from .landing import Landing, load_landing, read_records
from .releases import InPlace, ReleaseConflict, Releases
from .staging import new_path, own_folder, stage, staging_root
from .tables import read_if_present, write_table

__all__ = [
    "InPlace",
    "Landing",
    "ReleaseConflict",
    "Releases",
    "load_landing",
    "new_path",
    "own_folder",
    "read_if_present",
    "read_records",
    "stage",
    "staging_root",
    "write_table",
]
