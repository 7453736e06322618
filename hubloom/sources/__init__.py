"""Where rows come from and where commands go."""
