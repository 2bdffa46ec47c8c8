"""A PySpark engine that measures how easily web and product content can be extracted and quoted."""
