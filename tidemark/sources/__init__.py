"""Sources and sinks: landing zone, tables, versioned snapshots, histories."""
