"""DataFrame -> DataFrame operators (joins, aggregation, windows, quality, statistics, models, clustering, text)."""
