"""DataFrame operators: vocabulary, tokenization, chunking, sampling, splitting, evaluation."""
