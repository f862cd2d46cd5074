"""What is computed: bronze, silver, metrics and data quality. All lazy; nothing here runs a job."""
