"""Reading and writing: flow trees, lookup tables, models, HTML pages, scratch tables."""
