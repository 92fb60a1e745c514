"""Reading landed snapshots: files with hashes, workbooks, CSV, tables that may be absent."""
