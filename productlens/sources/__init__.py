"""Sources and sinks: driver-table relabelling, CSV source/sink, layered warehouse storage."""
