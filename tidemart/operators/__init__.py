"""DataFrame -> DataFrame steps; the same code serves batch and streaming."""
