"""Operations of a training-data pipeline: mixing, packing, filtering and deduplication."""
