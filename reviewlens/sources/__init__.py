from reviewlens.sources.layout import Layout, row_buckets, store_star, wide_from_star
from reviewlens.sources.lineage import cut_lineage, training_rows
from reviewlens.sources.models import load_models, save_models
from reviewlens.sources.tables import (
    export_counts,
    from_rows,
    read_counts,
    read_features,
    read_table,
    register_views,
    write_features,
)

__all__ = [
    "Layout", "cut_lineage", "export_counts", "from_rows", "load_models", "read_counts", "read_features",
    "read_table", "register_views", "row_buckets", "save_models", "store_star", "training_rows",
    "wide_from_star", "write_features",
]
