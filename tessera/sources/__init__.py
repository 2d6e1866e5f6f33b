"""Sources and sinks: map XML, boundary XML, and the table store."""
