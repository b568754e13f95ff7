"""Where rows come from and go to: CSV, Parquet, catalog tables and views."""
