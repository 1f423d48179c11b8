"""Sources and sinks: driver tables, landing files -> bronze, gold writers, file ingestion."""
