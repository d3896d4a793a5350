"""Sources and sinks: raw files to Bronze, yearly sets, calendar, writers."""
