"""Reading files, pages and listings; writing tables, results and reports."""
