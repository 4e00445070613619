"""Sources and sinks: table scans, the fixture adapter, schemas, the table store."""
