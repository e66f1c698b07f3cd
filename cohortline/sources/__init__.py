"""Sources (catalogue tables, readers, role mapping of the test tables) and sinks."""

from cohortline.sources.catalog import SchemaMismatch, Sources, catalogue_sources, read_table
from cohortline.sources.fixtures import load_sources
from cohortline.sources.sinks import register_view, save_table
from cohortline.sources.tables import drop_database, new_database, save_bucketed, save_sources

__all__ = ["SchemaMismatch", "Sources", "catalogue_sources", "drop_database", "load_sources", "new_database",
           "read_table", "register_view", "save_bucketed", "save_sources", "save_table"]
