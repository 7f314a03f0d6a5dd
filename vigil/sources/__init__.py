"""Sources: capture CSV, label files, driver tables, stream envelopes, model bundles."""
