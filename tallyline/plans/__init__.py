"""The six analytics and the batch run that publishes them."""
