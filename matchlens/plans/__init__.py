"""Jobs: daily flatten, statistics, warehouse refresh."""
