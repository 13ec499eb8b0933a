"""Copy whole databases of tables into clean, dated snapshots with Spark."""
