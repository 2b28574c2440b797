"""DataFrame -> DataFrame steps, chained with ``df.transform``."""
