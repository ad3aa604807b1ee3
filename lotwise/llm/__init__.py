"""Training-data operators: language ID, URL filters, token counts, sharding,
decontamination, chat formatting, SentencePiece, deduplication and PII."""
