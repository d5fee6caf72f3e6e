"""Reading the partitioned bid log."""
