"""Operations of a training-data pipeline: search, token counts, shards, mixes, duplicates, filters, packing, language models."""
