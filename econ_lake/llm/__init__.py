"""Training-data operators: dedup, tokenizers, classifiers, decontamination, sharding, chat."""
