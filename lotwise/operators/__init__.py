"""DataFrame-to-DataFrame operators shared by the batch and the stream job."""
