"""Plant-operations lakehouse on Spark: contracts, layers, marts, KPIs and sensor streams."""
