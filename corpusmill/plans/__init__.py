"""The end-to-end curation job and the registered queries with their SQL twins."""
