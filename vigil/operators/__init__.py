"""DataFrame -> DataFrame operators; each works on batch and streaming input."""
