"""cohortloom: a Spark-first engine for clinical-trial and drug data."""
