"""flowlake: labelled flow-record analytics expressed as Spark DataFrame jobs."""
