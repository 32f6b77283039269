"""Reading: file listings, CSV, delimiter detection, catalog and file metadata."""
