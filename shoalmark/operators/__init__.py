"""Table operators: inference, typed load, upsert, replace, versions, quality, maintenance, metrics."""
