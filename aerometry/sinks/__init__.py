"""Sinks: result tables, previews, published messages."""
