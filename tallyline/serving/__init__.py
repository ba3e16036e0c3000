"""Read side: what a dashboard asks of the published tables."""
