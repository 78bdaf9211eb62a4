"""Reading documents, planning loads, and keyed writes."""
