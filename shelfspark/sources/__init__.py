"""Sources and sinks: given tables, files, JDBC, keyed tables, fitted parameters."""
