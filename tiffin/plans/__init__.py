"""The layers of the pipeline and their order."""
