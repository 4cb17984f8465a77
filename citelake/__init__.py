"""Citation corpus engine: bulk bibliographic records to a searchable, year-partitioned table."""
