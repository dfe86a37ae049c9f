"""Training-data operators: quality, filtering, de-duplication, packing and archives."""
