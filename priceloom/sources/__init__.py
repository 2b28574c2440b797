from priceloom.sources.quarantine import Quarantined, read_quarantined
from priceloom.sources.readers import SourceUnavailable, json_to_csv, read_first, read_table
from priceloom.sources.scratch import checkpointed, discard, ensure_checkpoint_dir, scratch_path, written
from priceloom.sources.shapes import flat, read_shapes
from priceloom.sources.writers import load_model, save_model, write_table

__all__ = [
    "Quarantined",
    "SourceUnavailable",
    "checkpointed",
    "discard",
    "ensure_checkpoint_dir",
    "flat",
    "json_to_csv",
    "load_model",
    "read_first",
    "read_quarantined",
    "read_shapes",
    "read_table",
    "save_model",
    "scratch_path",
    "write_table",
    "written",
]
