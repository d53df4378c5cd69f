"""Jobs: silver transforms, gold dimensions and fact, reports, the pipeline."""
