"""Every operator on the sample tables, and the SQL that gives the same rows."""
