"""Reading sources and managing tables."""

from .catalog import (LAYERS, describe, detail, drop_table, field_types, get_properties, init_layers, plan_text, preview,
                      read_table, register_view, replace_table, set_properties, unset_properties, write_table)
from .files import bad_records, columns_of, header_manifest, ingest_all, read_csv, with_ingest_metadata
from .schemas import SOURCES, Source, source
