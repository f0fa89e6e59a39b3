"""Sky-frame analytics expressed as Spark DataFrame plans."""
