"""Where rows come from and go to: landing tables, result files, raw documents."""
