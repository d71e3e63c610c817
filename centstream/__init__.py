"""Payment-event analytics expressed as Spark DataFrame transforms."""
