"""Sample tables: reading, writing, and assembling them from raw event logs."""
