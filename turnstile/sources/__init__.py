"""Where rows come from and where they are kept."""
