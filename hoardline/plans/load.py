"""Imports every module that registers queries."""

from hoardline.plans import (  # noqa: F401
    audit_queries,
    catalogue_queries,
    cluster_queries,
    export_queries,
    file_queries,
    pairing_queries,
    split_queries,
    vector_queries,
)
