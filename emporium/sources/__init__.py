"""Raw shop sources: declared schemas, CSV seeds with landing upserts, and the
adapter from the driver's tables."""
