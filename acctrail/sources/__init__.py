"""Sources and sinks: table scans, role views, CSV loads, writes."""
