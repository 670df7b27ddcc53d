"""Readers: landed page files, page/call-log tables, register documents, relation resolution."""
