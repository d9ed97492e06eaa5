"""Independent SQL for the registered queries, run by another engine on the same files."""
