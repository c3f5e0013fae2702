"""Sources and sinks: driver tables as count matrices, matrix files, bundles."""
