"""matchloom: head-to-head match analytics expressed as Spark DataFrame plans."""
