"""DataFrame -> DataFrame operators of the pipeline and its reports."""
