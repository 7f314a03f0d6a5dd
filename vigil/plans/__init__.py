"""Jobs and the registered query catalogue (bindings to the driver's tables)."""
