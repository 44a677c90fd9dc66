"""Sources: text-format readers of the reference (S1-S7) and the driver's
parquet tables with their mapping onto the reference data model."""
