"""DataFrame -> DataFrame operators of the market-data model."""
