"""Where tables come from: files, catalogs, databases and exported records."""
