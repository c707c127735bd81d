"""DataFrame transforms: upserts, documents, archetypes, views, readers, reconciliation."""
