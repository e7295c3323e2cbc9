"""DataFrame -> DataFrame operators; each chains through ``DataFrame.transform``."""
