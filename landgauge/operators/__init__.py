"""DataFrame -> DataFrame operators; column names are parameters, nothing here does file I/O."""
