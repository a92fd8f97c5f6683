"""Reading HTML-table files, text CSV and web pages; writing tables and reports."""
