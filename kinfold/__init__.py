"""Record linkage and corpus operators as lazy DataFrame pipelines."""
