"""Sources and sinks: driver tables, the messy customer view, CSV string scans,
row numbering, result sinks."""
