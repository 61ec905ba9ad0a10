"""Where rows come from: JSON and Avro topics, lake tables and the test tables."""
