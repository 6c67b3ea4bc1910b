"""Training-data operators: text, embeddings and web captures at corpus scale."""
