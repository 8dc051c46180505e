"""Sources: text feed, workbooks, JDBC extracts, file manifest, driver fixtures."""
