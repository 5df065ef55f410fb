"""Sources and sinks: schemas, source loading, month snapshots, report export."""
