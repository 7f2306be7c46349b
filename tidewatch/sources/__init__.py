"""Where records come from: topics, tables, text files, JDBC."""
