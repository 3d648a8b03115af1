"""Landing readers and writers, and the table layouts."""
