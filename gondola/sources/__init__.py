"""Reading and writing: landing archives, raw delimited files, tables and exports."""
