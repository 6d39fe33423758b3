"""Scene arrivals as a stream: an extension beside the batch stages."""
