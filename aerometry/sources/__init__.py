"""Sources: sensor tables, device directory, payload feed, message streams."""
