"""Layer plans: bronze ingest, silver split, gold marts, profiling reports."""
