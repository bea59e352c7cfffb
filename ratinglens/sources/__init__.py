"""Reading and writing contract tables, and shaping landed API responses."""
