"""Where results go: partitioned lake tables and keyed tables fed by streams."""
