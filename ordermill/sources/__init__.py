"""Where rows come from: warehouse tables, CSV files, event streams, test tables."""
