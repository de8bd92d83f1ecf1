"""Where rows come from and go to: landing folders, Parquet files, catalog tables."""
