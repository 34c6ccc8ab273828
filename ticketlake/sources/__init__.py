"""Sources: landed API pages, point lookups, typed NDJSON, driver-table fixtures."""
