"""Sources: file readers (S3-S7), JDBC options (S1, S2) and fixture adapters."""
