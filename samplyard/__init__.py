"""Sample-metadata engine on PySpark: every operator maps DataFrames to DataFrames."""

from samplyard.schema import FieldSpec, SchemaSpec
from samplyard.session import build_session, work_path

__all__ = ["FieldSpec", "SchemaSpec", "build_session", "work_path"]
