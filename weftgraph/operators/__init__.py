"""Set-wise operators: ids, registry, resolution, lookups, indexes."""
