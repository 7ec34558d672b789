"""Training-data operators: documents and embeddings at corpus scale."""
