"""Sources: test tables, text lines, Kafka options, framed Avro."""
