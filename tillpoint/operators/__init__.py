"""DataFrame-in, DataFrame-out operators: validation, feature tables, panel, data quality, ML, reports."""
