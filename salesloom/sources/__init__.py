"""Files in and out: readers, sinks, the table store."""
