"""Where tables go: versioned snapshots, registry tables and databases."""
