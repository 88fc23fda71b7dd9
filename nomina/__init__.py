"""Organisation-name matching and resolution as Spark DataFrame operators."""
