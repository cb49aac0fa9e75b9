"""Reading and writing: raw landing folders, the warehouse, message streams."""
