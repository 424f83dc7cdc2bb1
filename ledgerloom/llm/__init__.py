"""Training-data operators: dedup, language-model scores, decontamination, shards, BPE, quality, PII, archives, URLs."""
