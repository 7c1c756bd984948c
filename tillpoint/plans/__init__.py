"""Job plans (feature, audit, forecast) and the catalogue of registered queries with their SQL oracles."""
