"""Sources: base parquet tables and the domain relations derived from them."""
