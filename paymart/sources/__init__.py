"""Sources and sinks: raw fixtures, CSV landing, bronze ingest, table IO."""
