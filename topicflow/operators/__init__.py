"""DataFrame -> DataFrame operators; all but ranking run on streams unchanged."""
