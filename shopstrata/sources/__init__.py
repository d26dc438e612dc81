"""Where rows come from: topics, JDBC tables, dimension stores and the sample tables."""
