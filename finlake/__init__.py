"""finlake: company filings from raw archives to a star schema, as Spark DataFrame jobs."""
